"""Cleaning, tagging and preparation."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from papyra.operators import clean, select, tag
from papyra.plans.prepare import prepare_papers

LONG = "A sufficiently long title about nothing"
NOVEL = "novel coronavirus and sars-cov-2"
EDGE_ROWS = [
    (1, "nosocomial spread", "alpha text", "2019-01-01"),
    (2, "nosocomial epidemic", "beta text", "2019-01-01"),
    (3, "CORONA notes", "gamma text", "2019-01-01"),
    (4, "customers survey", "delta text", "2019-01-01"),
    (5, None, None, None),
    (6, "short", "Unknown", "2019"),
    (7, LONG, None, "2020"),
    (8, LONG, "Abstract Viral load in sars patients", "2019"),
    (9, LONG, NOVEL, "2005-05-05"),
    (10, LONG, "wuhan market", "2005-05-05"),
    (11, LONG, "bad date", "garbage"),
    (12, LONG, NOVEL, "2005-05-05"),
    (13, LONG, "line one\nsars line two", "2010-03"),
]
# doc_id: title, abstract, date, tags (c covid, v virus, o corona, s sars)
EXPECTED = {
    1: ("", "alpha text", "2019-01-01", ""),
    2: ("nosocomial epidemic", "beta text", "2019-01-01", ""),
    3: ("", "gamma text", "2019-01-01", ""),
    4: ("customers survey", "delta text", "2019-01-01", ""),
    5: ("", "", "", "c"),
    7: (LONG, LONG, "2020-01-01", "c"),
    8: (LONG, " Viral load in sars patients", "2019-01-01", "s"),
    9: (LONG, NOVEL, "2005-05-05", "cvo"),
    10: (LONG, "wuhan market", "2005-05-05", ""),
    11: (LONG, "bad date", None, "c"),
    13: (LONG, "line one\nsars line two", "2010-03-01", "s"),
}
SCHEMA = "doc_id long, title string, abstract string, publish_time string"


def edge_papers(spark, rows=EDGE_ROWS):
    return spark.createDataFrame(rows, SCHEMA).withColumn("url", F.lit("http://x"))


def outcome(prepared):
    tags = [("c", "covid_related"), ("v", "virus_related"), ("o", "corona_related"),
            ("s", "sars_related")]
    return {
        r["doc_id"]: (
            r["title"], r["abstract"], r["publish_time"],
            "".join(letter for letter, column in tags if r[column]),
        )
        for r in prepared.collect()
    }


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_edge_rows(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert outcome(prepare_papers(edge_papers(spark))) == EXPECTED
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_order_and_partitions_do_not_matter(spark):
    papers = edge_papers(spark, EDGE_ROWS[::-1]).repartition(7)
    assert outcome(prepare_papers(papers)) == EXPECTED


def test_rows_without_id_keep_one_of_equal_rows(spark):
    papers = edge_papers(spark).union(edge_papers(spark)).drop("doc_id")
    prepared = prepare_papers(papers)
    assert prepared.count() == len(EXPECTED)
    assert prepared.select("abstract").distinct().count() == len(EXPECTED)


def test_row_id_tells_fields_and_nulls_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, ""), ("", None), ("-", "="), ("=", "-")]
    ids = clean.add_doc_id(spark.createDataFrame(rows, "x string, y string"))
    assert ids.select("doc_id").distinct().count() == len(rows)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(
    st.one_of(st.none(), st.text("ab vsr", max_size=40)),
    st.one_of(st.none(), st.just("Unknown"), st.text("corna vius\n", max_size=12)),
    st.one_of(st.none(), st.sampled_from(["2019", "2020", "2021-02-03", "x", ""])),
), min_size=1, max_size=30))
def test_properties(spark, rows):
    papers = edge_papers(spark, [(i, *row) for i, row in enumerate(rows)])
    result = prepare_papers(papers).collect()
    abstracts = [r["abstract"] for r in result]
    assert len(set(abstracts)) == len(abstracts) and None not in abstracts
    for r in result:
        tags = [r[c] for c in r.asDict() if c.endswith("_related")]
        assert len(tags) == 4 and None not in tags
        assert not (r["sars_related"] and r["covid_related"])


def test_covid_terms_must_be_a_list(spark):
    with pytest.raises(TypeError):
        tag.tag_covid(edge_papers(spark), covid_terms="covid")


def test_patterns_of_the_caller(spark):
    tagged = tag.tag_coronavirus(edge_papers(spark), corona_pattern="alpha")
    assert [r["doc_id"] for r in tagged.filter("corona_related").collect()] == [1]


def test_fill_nulls_leaves_other_columns(spark):
    row = clean.fill_nulls(edge_papers(spark)).filter("doc_id = 5").first()
    assert row["abstract"] == "" and row["title"] is None


def test_date_filters(spark):
    dates = [(1, "2022-01-01"), (2, "2021-12-31"), (3, ""), (4, None), (5, "2023")]
    df = spark.createDataFrame(dates, "doc_id long, publish_time string")

    def ids(result):
        return sorted(r["doc_id"] for r in result.collect())

    assert ids(select.after(df, "2022-01-01")) == [1, 5]
    assert ids(select.since_cutoff(df)) == [1, 5]
    assert ids(select.since_cutoff(df, include_null_dates=True)) == [1, 4, 5]
    both = select.after(df, "2022-01-01", include_null_dates=True, blank_as_null=True)
    assert ids(both) == [1, 3, 4, 5]


def test_keyed_sample_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    some = {r[0] for r in select.sample_rows(df, 0.1, 7, "doc_id").collect()}
    again = {r[0] for r in select.sample_rows(df.repartition(9), 0.1, 7, "doc_id").collect()}
    assert some == again and 1_800 < len(some) < 2_200
    assert select.sample_rows(df, 1.0, 7, "doc_id").count() == 20_000
    assert select.sample_rows(df, 0.0, 7, "doc_id").count() == 0
    assert 1_800 < select.sample_rows(df, 0.1, 7).count() < 2_200


def test_one_text_in_a_third_of_all_rows(spark):
    df = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("abstract"),
    )
    kept = clean.drop_duplicate_texts(df.repartition(8))
    assert kept.count() == 2_001
    assert [r[0] for r in kept.filter("abstract = 'same'").select("doc_id").collect()] == [0]


@pytest.mark.parametrize("few", [True, False])
def test_copies_go_whatever_their_number(spark, few, monkeypatch):
    monkeypatch.setattr(clean, "can_broadcast", lambda df: few)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"t{i % 40}", "x", i) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "doc_id long, abstract string, text_hash string, lowest long").repartition(5)
    kept = clean.drop_duplicate_texts(df)
    assert kept.columns == df.columns
    first = {}
    for i, text, _, _ in rows:
        first.setdefault(text, i)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert clean.drop_duplicate_texts(df.limit(0)).collect() == []
