"""Reading, writing, tables and the batch job."""

import pytest

from papyra.plans import job
from papyra.sources.files import header_groups, read_files, write_files
from papyra.sources.scratch import scratch_path
from papyra.sources.tables import read_table, register_table

HEADER = "title,abstract,publish_time,authors,doi,journal,url\n"


def write_csv(path, *lines):
    path.write_text(HEADER + "".join(line + "\n" for line in lines))
    return str(path)


def test_csv_is_text_with_nulls(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", 'one,,2020,"",x,,u')
    df = read_files(spark, path, "csv")
    assert {t for _, t in df.dtypes} == {"string"}
    row = df.first()
    assert row["publish_time"] == "2020" and row["abstract"] is None and row["authors"] is None


def test_line_breaks_in_quotes(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", 'one,"line\nbreak ""x""",2020,,,,u')
    assert read_files(spark, path, "csv").count() == 2
    row = read_files(spark, path, "csv", multiLine=True, escape='"').collect()
    assert [r["abstract"] for r in row] == ['line\nbreak "x"']


def test_many_paths_and_schema(spark, tmp_path):
    paths = [write_csv(tmp_path / f"{i}.csv", f"t{i},text,2020,,,,u") for i in range(3)]
    assert read_files(spark, paths, "csv").count() == 3
    assert read_files(spark, str(tmp_path / "*.csv"), "csv").count() == 3
    schema = "title string, abstract string, publish_time string, authors string, doi string," \
             " journal string, url string"
    assert read_files(spark, str(tmp_path), "csv", schema=schema).count() == 3


def test_files_with_unlike_headers_keep_their_own_names(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("title,abstract,url\nT1,A1,U1\n")
    (tmp_path / "b[1].csv").write_text("abstract,title,url\r\nA2,T2,U2\r\n")
    (tmp_path / "c.csv").write_text('url,more,title\nU3,"M,3",T3\n')
    (tmp_path / "d.csv").write_text("title,abstract,url\nT4,A4,U4\n")
    (tmp_path / "e.csv").write_text("")
    df = read_files(spark, str(tmp_path), "csv")
    assert sorted(df.columns) == ["abstract", "more", "title", "url"]
    found = sorted(tuple(r[c] for c in ("title", "abstract", "url", "more")) for r in df.collect())
    assert found == [("T1", "A1", "U1", None), ("T2", "A2", "U2", None), ("T3", None, "U3", "M,3"), ("T4", "A4", "U4", None)]
    assert [len(files) for files in header_groups(spark, [str(tmp_path)])] == [1, 2, 1]
    part = read_files(spark, str(tmp_path), "csv", "url string, abstract string, day date")
    assert part.columns == ["url", "abstract", "day"]
    assert sorted(map(tuple, part.collect()), key=repr)[2] == ("U3", None, None)
    assert read_files(spark, str(tmp_path / "e.csv"), "csv", "a string").collect() == []


def test_header_groups_read_only_first_lines_in_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("papyra.sources.files.HEADER_TASKS", 3)
    for number in range(10):
        names = ["title", "abstract"][:: 1 if number % 3 else -1]
        (tmp_path / f"{number}.csv").write_text(",".join(names) + "\n" + "".join(f"{n},{n}\n" for n in range(50)))
    assert sorted(map(len, header_groups(spark, [str(tmp_path)]))) == [4, 6]
    assert read_files(spark, str(tmp_path), "csv").count() == 500


def test_write_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    write_files(spark.range(5), path)
    write_files(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_register_again_after_rewrite(spark, tmp_path):
    path = str(tmp_path / "out")
    write_files(spark.range(3).withColumnRenamed("id", "doc_id"), path)
    assert register_table(spark, "registered", path).count() == 3
    write_files(spark.range(9).selectExpr("id AS doc_id", "id AS more"), path)
    assert register_table(spark, "registered", path).columns == ["doc_id", "more"]
    assert [r["doc_id"] for r in read_table(spark, "registered", 4).collect()] == [0, 1, 2, 3]
    assert read_table(spark, "registered").count() == 9


def test_managed_tables_are_left_alone(spark, tmp_path):
    spark.range(1).write.mode("overwrite").saveAsTable("managed")
    with pytest.raises(ValueError):
        register_table(spark, "managed", str(tmp_path))
    assert spark.table("managed").count() == 1


def test_scratch_path_is_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_job_arguments():
    args = job.JobArguments.parse(["job.py", "DEV", "in", "csv", "out"])
    assert (args.env, args.input_path, args.input_format, args.output_path) == (
        "DEV", "in", "csv", "out"
    )
    args = job.JobArguments.parse([
        "job.py", "DEV", "a,b.csv", "csv", "out", "--input", "c.csv", "--option", "multiLine=true",
        "--option", 'escape="', "--id", "key", "--sample", "0.5", "--schema", "key long, title string",
    ])
    assert args == job.JobArguments(
        "DEV", "a,b.csv", "csv", "out", ("c.csv",), (("multiLine", "true"), ("escape", '"')),
        "key long, title string", "key", 0.5,
    )
    for wrong in (["DEV", "in", "csv"], ["DEV", "in", "csv", "out", "more"], ["DEV", "in", "csv", "out", "--option", "x"]):
        with pytest.raises(ValueError):
            job.JobArguments.parse(["job.py", *wrong])


def test_job_with_options_and_ids(spark, tmp_path):
    path = tmp_path / "a,b.csv"
    path.write_text('key,title,abstract,publish_time,url\n7,a title,"two\nlines ""x""",2020,u\n')
    args = job.JobArguments("DEV", str(path), "csv", str(tmp_path / "out"), (), (("multiLine", "true"), ("escape", '"')), None, "key")
    job.run(args)
    row = spark.read.parquet(args.output_path).first()
    assert (row["doc_id"], row["abstract"]) == ("7", 'two\nlines "x"')


def test_session_on_this_machine(spark):
    from papyra.sources.session import get_session

    assert get_session("DEV").sparkContext.master.startswith("local")


def test_job_finds_duplicates_across_files(spark, tmp_path):
    one = write_csv(tmp_path / "1.csv", "covid vaccine one,same text,2020,,,,u1")
    two = write_csv(
        tmp_path / "2.csv", "covid vaccine two,same text,2020,,,,u2", "x,other,2019,,,,u3"
    )
    out = str(tmp_path / "out")
    job.run(job.JobArguments("DEV", one, "csv", out, more_inputs=(two,)))
    rows = {r["abstract"]: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"same text", "other"}
    assert rows["other"]["title"] == "" and rows["same text"]["publish_time"] == "2020-01-01"
    job.run(job.JobArguments("DEV", one, "csv", out, more_inputs=(two,), sample_fraction=0.0))
    assert spark.read.parquet(out).count() == 0
