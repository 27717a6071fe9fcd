"""Stages over rows with null, repeated and text ids and with columns of any name."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from papyra.llm import quality_rules, toxicity
from papyra.llm.labels import agreed_labels
from papyra.llm.packing import pack
from papyra.llm.stored import numbered_in_place
from papyra.llm.token_counts import token_counts

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()
PASSAGE = " ".join(f"bench{i}" for i in range(30))
NAMES = ["_row", "_ROW_", "_spans", "_merged", "_text", "id", "row", "at", "group", "component_id", "n_words", "kept", "hash"]


def clean(seed):
    return " ".join(f"{w}{(seed * 7 + i) % 97}" for i, w in enumerate(WORDS * 2))


ROWS = [
    (None, "short"), (None, clean(1)), (None, clean(1)), (1, clean(2)), (1, clean(2)), (2, clean(2) + " more"),
    (5, clean(3)), (5, PASSAGE), (None, PASSAGE + " tail"), (6, clean(4) + " password = abcdefgh12345"), (6, "too short"),
    (7, None), (8, clean(5) + " " + "q " * 3),
]


@pytest.fixture(scope="module", params=["long", "string"])
def stages(request, spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    kind = request.param
    rows = [(None if i is None else i if kind == "long" else f"k{i}", text, "en", "s", *[f"{n}{at}" for n in NAMES])
            for at, (i, text) in enumerate(ROWS)]
    more = ", ".join(f"`{name}` string" for name in NAMES)
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string, lang string, source string, {more}").repartition(3)
    spark.createDataFrame([], f"doc_id {kind}, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, results[-1], folder).write.parquet(f"{folder}/{name}")
        results.append(spark.read.parquet(f"{folder}/{name}"))
    return results


def places(df):
    """Numbers of the rows of ``ROWS``, from a clashing column."""
    return sorted(int(r["_row"][4:]) for r in df.collect())


def test_each_row_is_judged_for_itself(stages):
    assert places(stages[1]) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 12]
    after = places(stages[2])
    assert len(after) == 6 and {6, 9, 12} < set(after)
    assert len({1, 2} & set(after)) == 1 and len({3, 4, 5} & set(after)) == 1 and 5 not in after
    assert len({7, 8} & set(after)) == 1
    assert set(places(stages[3])) == set(after) - {7, 8}
    assert places(stages[4]) == places(stages[3])


def test_columns_keep_their_names_and_values(stages):
    for stage in stages[1:5]:
        assert stage.columns == stages[0].columns
        for r in stage.collect():
            at = int(r["_row"][4:])
            assert [r[name] for name in NAMES] == [f"{name}{at}" for name in NAMES]
    texts = {int(r["_row"][4:]): r.text for r in stages[4].collect()}
    assert "abcdefgh12345" not in texts[9] and texts[6] == ROWS[6][1]


def test_pieces_carry_the_given_ids(stages):
    kind = dict(stages[0].dtypes)["doc_id"]
    assert dict(stages[5].dtypes)["doc_id"] == kind
    whole = stages[5].groupBy("doc_id").agg(F.count("*")).collect()
    assert {r.doc_id for r in whole} == {r.doc_id for r in stages[4].collect()}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_contradicting_labels_teach_nothing(spark):
    rows = [(1, 0), (1, 1), (2, 1), (2, 1), (3, None), (3, 0), (None, 1), (4, 7)]
    for partitions in (1, 3, 5):
        labels = spark.createDataFrame(rows, "doc_id long, quality int").repartition(partitions)
        found = agreed_labels(labels, "doc_id", "quality", "good").collect()
        assert sorted(map(tuple, found)) == [(2, 1), (3, 0)]


def test_documents_of_one_id_are_one_holdout(spark):
    text = clean(1)
    docs = spark.createDataFrame([(1, text, "en")] * 50 + [(2, text + " !", "en")], "doc_id long, text string, lang string")
    measured = quality_rules.measures(docs.withColumnRenamed("text", "_text"), "_text")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    limits = {rule: (0.0,) for rule in quality_rules.RULES}
    assert limits and quality_rules.certified_cutoffs(measured, labels).collect() == []


def test_text_ids_are_kept(spark):
    docs = spark.createDataFrame([("a", "some text here", "x"), (None, None, "y")], "doc_id string, text string, score string")
    assert {r.doc_id for r in pack(docs).collect()} == {"a", None}
    assert {r.doc_id for r in token_counts(docs).collect()} == {"a", None}
    machine = toxicity.train(docs, spark.createDataFrame([], "doc_id string, toxic int"))
    assert {r.doc_id for r in toxicity.score(docs, machine).collect()} == {"a", None}


def test_rows_of_files_are_numbered_in_place(spark, tmp_path):
    rows = [(i % 7, f"t{i}", "a", "b") for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, text string, _file string, _place string").repartition(5).write.parquet(
        str(tmp_path / "t")
    )
    df = spark.read.parquet(str(tmp_path / "t"))
    found = numbered_in_place(df, "_row")
    assert found.columns == [*df.columns, "_row"]
    first = {r["_row"]: r.text for r in found.collect()}
    assert len(first) == 500 and {r["_row"]: r.text for r in found.repartition(3).collect()} == first
    assert not list(tmp_path.glob("*numbered*")) and "numbered" not in "".join(found.inputFiles())
    assert numbered_in_place(spark.createDataFrame(rows, df.schema), "_row").select("_row").distinct().count() == 500
