"""Keyed writes against a plain-Python model of the per-record rules (property test)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordset.operators import keyed_write as W
from recordset.sources import store as S

AS_OF = 1_000
KEYS = [f"k{i}" for i in range(6)]

target_rows = st.dictionaries(
    st.sampled_from(KEYS),
    st.tuples(st.integers(1, 3), st.sampled_from([0, AS_OF - 5, AS_OF + 5]), st.integers(0, 9), st.integers(0, 9)),
    max_size=5,
)
incoming_rows = st.dictionaries(
    st.sampled_from(KEYS), st.tuples(st.one_of(st.none(), st.integers(10, 19)), st.integers(0, 3)), min_size=1, max_size=5
)


def model(target, incoming, mode, check):
    out = {}
    for key in set(target) | set(incoming):
        t, i = target.get(key), incoming.get(key)
        keep = (lambda: out.__setitem__(key, {"gen": t[0], "exp": t[1], "a": t[2], "b": t[3]}) if t else None)
        if i is None:
            keep()
            continue
        live = t is not None and (t[1] == 0 or t[1] > AS_OF)
        if check and i[1] != (t[0] if live else 0):
            keep()
        elif live:
            if mode == "errorifexists":
                return "conflict"
            if mode == "ignore":
                keep()
            elif mode == "overwrite":
                out[key] = {"gen": t[0] + 1, "exp": t[1], "a": i[0], "b": None}
            else:
                out[key] = {"gen": t[0] + 1, "exp": t[1], "a": i[0], "b": t[3]}
        elif mode == "update_only":
            keep()
        else:
            out[key] = {"gen": 1, "exp": 0, "a": i[0], "b": None}
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=target_rows, incoming=incoming_rows,
       mode=st.sampled_from(["errorifexists", "ignore", "overwrite", "append", "update_only"]),
       check=st.booleans(), bound=st.booleans())
def test_merge_matches_model(spark, target, incoming, mode, check, bound):
    t = spark.createDataFrame([(k, g, e, a, b) for k, (g, e, a, b) in target.items()],
                              "key string, g int, e int, a bigint, b bigint")
    stored = S.as_set(t, "m", "key", generation=F.col("g"), expiry=F.col("e")).drop("g", "e")
    inc = spark.createDataFrame([(k, a, g) for k, (a, g) in incoming.items()], "key string, a bigint, __generation int")
    spec = W.WriteSpec("m", mode=mode, key_col="key", as_of=AS_OF,
                       generation_policy="expect_gen_equal" if check else "none")
    want = model(target, incoming, mode, check)
    if want == "conflict":
        try:
            with W.conflicts_raised():
                W.merge(stored, inc, spec, bound).collect()
        except W.WriteConflict:
            return
        raise AssertionError("expected a conflict")
    got = {r["__key"]: {"gen": r["__generation"], "exp": r["__expiry"], "a": r["a"], "b": r["b"]}
           for r in W.merge(stored, inc, spec, bound).collect()}
    assert got == want
