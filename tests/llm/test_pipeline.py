"""The registered queries and the pipeline."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from oracle_check import TABLES, table_hash
from recordset.llm import rules
from llm_helpers import LOWER, ODD_TEXTS, prose, space_words
from test_duplicates import brute_repeats
from test_texts import brute_hits

SF_SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in E.LLM_QUERIES if n != "pipeline") == sorted(f"op{i}" for i in range(1, 14)) and "pipeline" in E.LLM_QUERIES


@pytest.mark.parametrize("name", sorted(set(E.LLM_QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    assert table_hash(df.columns, [tuple(r) for r in df.collect()]) == table_hash([d[0] for d in res.description], res.fetchall())


def test_license_scan_runs_no_python(spark):
    plan = E.queries()["op10_license_scan"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages_do_what_they_say(spark):
    """Every stage's result against plain Python on the rows its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, state = docs.columns, docs
    model = rules.fit_rule_model(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "decontamination", "source_mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in state.collect()}
        rows = [(i, r.text) for i, r in before.items()]
        state = spark.createDataFrame(stage(spark, state, SF_SMALL).toArrow())
        after = {r.doc_id: r for r in state.collect()}
        if name != "source_mixing":
            assert state.columns == columns
        if name == "quality_rules":
            want = {r.doc_id for r in rules.apply_rules(docs, model).filter("kept").collect()}
            assert set(after) == want and all(after[i] == before[i] for i in after) and 0 < len(after) < len(before)
        elif name == "near_duplicates":
            assert set(after) == brute_near_duplicates(rows) and all(after[i] == before[i] for i in after)
        elif name == "repeated_passages":
            removed = {i: n for i, _, n, _, _ in brute_repeats(rows)}
            assert set(after) == set(before)
            assert all((after[i].text == before[i].text) == (removed[i] == 0) and after[i].n_chars == len(after[i].text) for i in after)
        elif name == "decontamination":
            assert set(after) == {i for i, t in rows if not brute_hits(t, items)[1]}
        else:
            assert set(after) == set(before) and len({(r.slot, r.place) for r in after.values()}) == len(after)


def brute_near_duplicates(rows, k=5, percent=80):
    """Smallest ids of the groups that links of k-word shingles make."""
    sets = {}
    for i, t in rows:
        w = space_words((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i for i in comp if find(i) == i}


def test_near_duplicates_of_five_words_and_80_percent(spark):
    rng = random.Random(12)
    rows = []
    for n in (40, 100, 200):  # copies with more and more at the end: some link at 80 percent but not at 85
        base = prose(rng, n)
        rows += [base] + [base + " " + prose(rng, n * share // 100) for share in (10, 18, 20, 22, 24, 30)]
        rows += [" ".join(base.split()[:n * share // 100]) for share in (75, 79, 82, 84, 90)]
    rows = list(enumerate(rows))
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    given = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], schema)
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, given, SF_SMALL).collect()} == brute_near_duplicates(rows)
    assert brute_near_duplicates(rows) != brute_near_duplicates(rows, 4, 85)


def test_stages_take_odd_and_empty_tables(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    rows = [(i if i != 3 else None, t, None, None if i % 2 else "s", None) for i, t in enumerate(ODD_TEXTS)] * 2
    for table in (rows, []):
        for name, stage in corpus_pipeline.STAGES:
            given = spark.createDataFrame(table, schema).withColumn("kept", F.lit("old")).withColumn("n_words", F.lit("old")).withColumn("_row", F.lit("old"))
            got = stage(spark, given, SF_SMALL)
            assert got.count() <= len(table) and got.columns[:8] == given.columns
            assert {(r["kept"], r["n_words"], r["_row"]) for r in got.collect()} <= {("old", "old", "old")}


def test_rows_of_one_id_and_odd_columns(spark):
    """Of rows with one id and different texts the same one stays however they are dealt; columns of operators' inner names are kept."""
    rng = random.Random(4)
    texts = [prose(rng, 60) for _ in range(12)]
    rows = [(i % 5, t, "en", f"s{i % 2}", None) for i, t in enumerate(texts)] + [(9, texts[0], "en", "s0", None)] * 2
    given = spark.createDataFrame(rows, spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema)
    kept = [sorted(map(tuple, corpus_pipeline.near_duplicates(spark, given.repartition(n), SF_SMALL).collect()), key=str) for n in (1, 3, 7)]
    assert kept[0] == kept[1] == kept[2] and len({r[0] for r in kept[0]}) == len(kept[0])
    odd = given.withColumns({c: F.lit(c) for c in ("_source", "_rank", "_h", "a.b", "_hash", "_least", "slot")})
    got = corpus_pipeline.mixed(spark, odd, SF_SMALL)
    assert got.columns == [*(c for c in odd.columns if c != "slot"), "block", "slot", "place"] and got.select("_rank", "`a.b`").distinct().collect() == [("_rank", "a.b")]
    assert corpus_pipeline.near_duplicates(spark, odd, SF_SMALL).columns == odd.columns
