import pytest
from pyspark.sql import functions as F

from tallyframe.plans import sessions
from tallyframe.session import fresh_folder, shared_folder
from tallyframe.sources import readers, writers


def put(tmp_path, name, data):
    path = tmp_path / name
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1"])
def test_any_encoding(spark, tmp_path, encoding):
    path = put(tmp_path, "a.csv", "id,name\n1,José\n2,Muñoz\n".encode(encoding))
    df = readers.read_csv_any_encoding(spark, path, ["id", "name"])
    assert [r["name"] for r in df.orderBy("id").collect()] == ["José", "Muñoz"]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1"])
def test_quotes_and_line_breaks_in_fields(spark, tmp_path, encoding):
    wild = 'Él said ""hi"", ok\nand left'
    path = put(tmp_path, "a.csv", f'id,name\n1,"{wild}"\n2,x\n'.encode(encoding))
    want = [(1, wild.replace('""', '"')), (2, "x")]
    assert [tuple(r) for r in readers.read_csv_any_encoding(spark, path).orderBy("id").collect()] == want
    if encoding == "utf-8":
        assert [tuple(r) for r in readers.read_csv(spark, path, "id int, name string").orderBy("id").collect()] == want
        assert [tuple(r) for r in readers.read_optional(spark, path, "id int, name string", "csv").orderBy("id").collect()] == want


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, str(tmp_path / "none.csv"))
    path = put(tmp_path, "a.csv", b"id,name\n1,x\n")
    with pytest.raises(ValueError, match="price"):
        readers.read_csv(spark, path, "id bigint, price double", expected=["id", "price"])


def test_types_follow_names_not_positions(spark, tmp_path):
    path = put(tmp_path, "a.csv", b"extra,price,id\nq,1.5,7\n")
    df = readers.read_csv(spark, path, "id bigint, price double", expected=["id", "price"])
    assert df.dtypes == [("extra", "string"), ("price", "double"), ("id", "bigint")]
    assert tuple(df.first()) == ("q", 1.5, 7)


def test_optional_input(spark, tmp_path):
    empty = readers.read_optional(spark, str(tmp_path / "none.parquet"), "a int, b string")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_texts_with_quotes_breaks_and_blanks_survive(spark):
    rows = [(1, ' lead "quoted", comma '), (2, "two\nlines"), (3, None)]
    df = spark.createDataFrame(rows, "id int, s string")
    path = writers.write_csv(df, fresh_folder(spark, "t"))
    back = readers.read_csv(spark, path, "id int, s string", multiline=True)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_sessions_come_whole_or_in_pages(spark):
    turns = spark.range(2500).select(
        F.when(F.col("id") < 2000, "long").when(F.col("id") < 2400, None).otherwise(F.col("id").cast("string")).alias("s"),
        F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text")).repartition(5)
    out = writers.sessions_as_messages(turns, "s", "turn", "role", "text", page=300).collect()
    assert sum(len(r["messages"]) for r in out) == 2500 and max(len(r["messages"]) for r in out) <= 300
    pages = sorted((r for r in out if r["s"] == "long"), key=lambda r: r["page"])
    assert [m["turn"] for r in pages for m in r["messages"]] == list(range(2000))
    assert len([r for r in out if r["s"] is None]) == 2
    whole = writers.sessions_as_messages(turns, "s", "turn", "role", "text")
    assert whole.columns == ["s", "start", "messages"]
    assert [m["turn"] for r in whole.where("s = 'long'").collect() for m in r["messages"]] == list(range(2000))
    flat = writers.session_messages(turns, "s", "turn", "role", "text").where("s = 'long'")
    assert flat.where("position = turn + 1").count() == 2000


def test_written_sessions_equal_the_collected_ones(spark):
    """Hot, null and one-message sessions, ties, nulls in every column, quotes and line breaks."""
    turns = spark.range(3000).select(
        F.when(F.col("id") < 1500, "hot").when(F.col("id") < 1600, None).otherwise((F.col("id") % 700).cast("string")).alias("s"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 97).alias("at"), F.when(F.col("id") % 5 > 0, "user").alias("role"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit('said "x",\n\\ é '), "id")).alias("text"), F.lit(1).alias("_order")).repartition(6)
    turns = turns.unionByName(turns.where("s = '3'")).unionByName(
        spark.createDataFrame([("lone", None, None, None, 1)], turns.schema))
    want = writers.sessions_as_messages(turns, "s", "at", "role", "text")
    path = writers.write_sessions(turns, "s", "at", "role", "text", fresh_folder(spark, "ws"))
    back = spark.read.schema(want.schema).json(path)
    assert back.count() == want.count()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, want.collect()))
    empty = writers.write_sessions(turns.limit(0), "s", "at", "role", "text", fresh_folder(spark, "ws"))
    assert spark.read.schema(want.schema).json(empty).count() == 0


def test_session_logs(spark, tmp_path):
    header = ",".join(sessions.LOG_COLUMNS)
    line = lambda **kw: ",".join(kw.get(c, "") for c in sessions.LOG_COLUMNS)
    for i in (1, 2):
        rows = [line(event_id="a", session_id=f"s{i}", timestamp="2026-01-01T00:00:00", event_type="SESSION_START"),
                line(event_id="b", session_id=f"s{i}", timestamp="2026-01-01T00:00:02", event_type="USER_MESSAGE", message_text_preview='"two\nlines"'),
                line(event_id="c", session_id=f"s{i}", timestamp="2026-01-01T00:00:01", event_type="USER_MESSAGE", message_text_preview="first")]
        put(tmp_path, f"session_{i}.csv", "\n".join([header, *rows, ""]).encode())
    logs = sessions.read_logs(spark, f"{tmp_path}/session_*.csv")
    out = sessions.conversations(logs).orderBy("session_id").collect()
    assert [r["session_id"] for r in out] == ["s1", "s2"]
    assert [m["content"] for m in out[0]["messages"]] == ["first", "two\nlines"]
    assert out[0]["start_time"] == "2026-01-01T00:00:01"
    path = sessions.write_conversations(logs, fresh_folder(spark, "logs"))
    assert spark.read.schema(sessions.conversations(logs).schema).json(path).orderBy("session_id").collect() == out
    assert sessions.session_totals(logs).where("events = 3 and messages = 2").count() == 2


def test_latest_run(spark):
    df = spark.createDataFrame([("r1", 1), ("r2", 2), ("r2", 3)], "run_id string, v int")
    assert readers.latest_run(df).count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_large_files_can_be_split_on_request(spark, tmp_path):
    """Without quoted line breaks both readings are equal; read_optional hands the choice on."""
    from tallyframe.sources.readers import read_csv, read_optional

    path = tmp_path / "rows.csv"
    path.write_text("a,b\n" + "".join(f"{i},x{i}\n" for i in range(2000)))
    whole = read_csv(spark, str(path), "a int, b string")
    split = read_csv(spark, str(path), "a int, b string", multiline=False)
    assert sorted(whole.collect()) == sorted(split.collect())
    assert read_optional(spark, str(path), "a int, b string", "csv", multiline=False).count() == 2000
    broken = tmp_path / "broken.csv"
    broken.write_text('a,b\n1,"x\ny"\n')
    assert read_optional(spark, str(broken), "a int, b string", "csv").first()["b"] == "x\ny"
