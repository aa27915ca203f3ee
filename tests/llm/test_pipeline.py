import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the house of a man and his dog stands near that river with old trees around it where children play in summer".split()


@pytest.fixture
def docs(spark):
    """Clean English texts of their own words, and odd ones beside them."""
    rng = random.Random(1)
    clean = lambda: " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "er"]) for _ in range(120))
    rows = [(i, clean(), "en", f"src{i % 3}", 1) for i in range(60)]
    rows += [(100, None, "en", "src0", None), (101, "", None, None, 0), (102, "123 456", None, "src1", 7), (103, "short text", "en", "src1", 10)]
    rows += [(104, "again and again " * 40, "en", "src2", 1), (105, rows[3][1], "en", "src2", 1), (106, rows[4][1] + " tail", None, None, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_what_is_clean_and_decide_the_rest(spark, docs):
    named = dict(pipeline.STAGES)
    assert list(named) == ["language_id", "quality_rules", "minhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    one = named["language_id"](spark, docs, "")
    assert one.columns == pipeline.COLUMNS and set(range(60)) <= set(ids(one)) and not {100, 101, 102} & set(ids(one))
    two = named["quality_rules"](spark, one, "")
    assert two.columns == pipeline.COLUMNS and ids(two) == [*range(60), 105, 106]
    three = named["minhash_near_dedup"](spark, two, "")
    assert three.columns == pipeline.COLUMNS and ids(three) == list(range(60))
    four = named["suffix_array_dedup"](spark, three, "")
    assert four.columns == pipeline.COLUMNS and ids(four) == list(range(60))
    assert {r["doc_id"]: r["text"] for r in four.collect()} == {r["doc_id"]: r["text"] for r in three.collect()}
    five = named["best_fit_packing"](spark, four, "")
    assert ids(five) == list(range(60)) and five.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_on_empty_and_repeated_rows(spark, docs, name):
    stage = dict(pipeline.STAGES)[name]
    empty = stage(spark, docs.limit(0), "")
    assert empty.collect() == []
    if name in ("language_id", "quality_rules", "minhash_near_dedup"):
        some = docs.where("doc_id < 3")
        out = stage(spark, some.union(some), "")
        assert ids(out) == [0, 0, 1, 1, 2, 2]


def test_suffix_stage_cuts_a_shared_passage_from_later_documents(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(5, f"start {passage} end", "en", "a", 1), (7, f"öther {passage} tail", "en", "a", 1), (9, passage[:40], "en", None, 1)]
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.suffix_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert out[5][0] == rows[0][1] and out[9][0] == passage[:40]
    # From the shared space before the passage to the shared space behind it.
    assert out[7] == ("öthertail", 9)


def test_pipeline_leaves_one_table_behind(spark, tmp_path):
    from pathlib import Path

    out = pipeline.run(spark, "/root/testdata/sf0.001")
    folder = Path(out.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parents[1]
    assert out.count() > 0 and [p.name for p in folder.iterdir()] == ["4_best_fit_packing"]
