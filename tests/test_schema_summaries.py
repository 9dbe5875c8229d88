"""Types of JSON bins from summaries kept beside the segments: the same as a pass over all records, opening changed buckets only."""

import json
import random

from pyspark.sql import functions as F

from recordset.operators import bucketed_write as B
from recordset.operators import keyed_write as W
from recordset.sources import layout, schema, skipping
from recordset.sources.skipping import where
from recordset.sources.store import scan_set

AS_OF = 100


def spec(name):
    return W.WriteSpec(name, mode="append", key_col="k", as_of=AS_OF)


def records(spark, rng, keys, conflict):
    def value():
        pool = [3, 2.5, "x", True, None, [1], [], [0.5], {"a": 1}, {"b": {"c": [1]}}, {}]
        return rng.choice(pool if conflict else pool[:2])

    rows = [(k, None if rng.random() < 0.1 else json.dumps({"n": k, "v": value(), **({f"late{k % 3}": value()} if conflict else {})})) for k in keys]
    return spark.createDataFrame(rows, "k bigint, j string")


def test_summaries_equal_the_full_pass(spark, tmp_out, monkeypatch):
    root, rng = f"{tmp_out}/js", random.Random(3)
    opened = []
    real = layout.read_buckets
    monkeypatch.setattr(layout, "read_buckets", lambda s, r, m, buckets=None, **kw: opened.append(buckets) or real(s, r, m, buckets, **kw))
    B.write_bucketed(spark, records(spark, rng, range(120), False), root, spec("js"), buckets=8, json_bins=("j",))
    for turn, keys in enumerate((range(3), range(200, 203), range(0, 120, 2))):
        B.write_bucketed(spark, records(spark, rng, keys, turn != 2), root, spec("js"))
        m = layout.latest_version(spark, root)[1]
        opened.clear()
        got = skipping.json_schema(spark, root, m, "j")
        changed = sorted(b for b, own in m.segments.items() if len(own) > 1)
        assert opened == ([changed] if changed else []) and len(changed) < 8
        assert got == schema.infer_schema(real(spark, root, m), "j"), turn
    B.compact(spark, root, AS_OF)
    m = layout.latest_version(spark, root)[1]
    opened.clear()
    assert skipping.json_schema(spark, root, m, "j") == schema.infer_schema(real(spark, root, m), "j") and opened == []
    # A finished mark that is missing, and a scan under a filter: all records still tell the types.
    layout.delete_path(spark, f"{skipping._folder(root, m.summaries['j'], 'types')}/w={m.segments[0][0].write}/_SUCCESS")
    assert skipping.json_schema(spark, root, m, "j") == schema.infer_schema(real(spark, root, m), "j") and opened
    view = scan_set(spark, root, as_of=AS_OF, json_bins="j", where=where("__key", "=", "2"))
    assert view.columns == scan_set(spark, root, as_of=AS_OF, json_bins="j").columns and view.count() == 1


def test_merging_summaries_in_any_order(spark):
    """The merge of types is associative, commutative and idempotent, unknown types being neutral."""
    kinds = [None, "BIGINT", "DOUBLE", "STRING", ("ARRAY", None), ("ARRAY", "BIGINT"), ("ARRAY", "DOUBLE"), ("MAP", "BIGINT"), ("MAP", ("ARRAY", "STRING"))]
    w = schema._widen
    for a in kinds:
        assert w(a, a) == a == w(a, None) == w(None, a)
        for b in kinds:
            assert w(a, b) == w(b, a)
            for c in kinds:
                assert w(w(a, b), c) == w(a, w(b, c))


def test_empty_set_and_plain_types(spark, tmp_out):
    root = f"{tmp_out}/none"
    B.write_bucketed(spark, spark.createDataFrame([], "k bigint, j string"), root, spec("none"), buckets=2, json_bins=("j",))
    m = layout.latest_version(spark, root)[1]
    assert skipping.json_schema(spark, root, m, "j").fields == []
    B.write_bucketed(spark, spark.range(4).select(F.col("id").alias("k"), F.lit('{"a": 1}').alias("j")), root, spec("none"))
    assert [f.simpleString() for f in skipping.json_schema(spark, root, layout.latest_version(spark, root)[1], "j").fields] == ["a:bigint"]
