"""SRC-2, SNK-2, SNK-10, SNK-16: options (the reference's config suite, store-free)."""

import pytest

from recordset.operators import keyed_write as W
from recordset.options import resolve


def test_defaults():
    o = resolve()
    assert o.schemaScan is None  # the whole set
    assert o.meta_columns == ("__key", "__digest", "__expiry", "__generation", "__ttl")
    assert o.saveMode == "ignore"
    assert o.generationPolicy == "none"


def test_case_insensitive_and_prefix():
    o = resolve(SCHEMASCAN="25", **{"recordset.keyColumn": "id"})
    assert o.schemaScan == 25 and o.keyColumn == "id"


def test_unknown_option_rejected():
    with pytest.raises(ValueError, match="unknown option"):
        resolve(seedhost="x")


def test_integer_options_are_real_ints():
    with pytest.raises(ValueError):
        resolve(schemaScan="many")
    with pytest.raises(ValueError):
        resolve(schemaScan=0)


def test_session_conf_then_explicit(spark):
    spark.conf.set("recordset.schemaScan", "7")
    try:
        assert resolve(spark).schemaScan == 7
        assert resolve(spark, schemaScan=9).schemaScan == 9  # explicit beats session
    finally:
        spark.conf.unset("recordset.schemaScan")


def test_save_mode_and_policy_validated():
    with pytest.raises(ValueError):
        resolve(saveMode="sometimes")
    with pytest.raises(ValueError):
        resolve(generationPolicy="maybe")
    assert resolve(saveMode="Append").saveMode == "append"


def test_write_key_rules():
    with pytest.raises(ValueError, match="not both"):
        resolve(updateByKey="k", updateByDigest="d").write_key()
    with pytest.raises(ValueError):
        resolve().write_key()
    assert resolve(updateByKey="k").write_key() == ("key", "k")
    with pytest.raises(ValueError):
        W.WriteSpec("s", key_col="a", digest_col="b")
    with pytest.raises(ValueError):
        W.WriteSpec("s")


def test_set_path_needs_set():
    with pytest.raises(ValueError):
        resolve().set_path()
    assert resolve(namespace="/data/ns/", set="dv").set_path() == "/data/ns/dv"


def test_default_save_mode_from_session(spark):
    assert W.default_mode(spark) == "ignore"
    spark.conf.set("recordset.saveMode", "Overwrite")
    try:
        assert W.default_mode(spark) == "overwrite"
    finally:
        spark.conf.unset("recordset.saveMode")
