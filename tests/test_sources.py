import pytest
from pyspark.sql import functions as F

from tokenloom.operators import dialogs, runs
from tokenloom.session import scratch_path, shared_dir
from tokenloom.sources import readers, sinks


@pytest.fixture
def folder(tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path)

    return put


def test_lines_are_numbered_over_files_and_splits(spark, folder):
    folder("b.txt", "".join(f"b{i}\n" for i in range(500)))
    path = folder("a.txt", "".join(f"a{i}\n" for i in range(500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    try:
        rows = readers.read_lines(spark, path).orderBy("line_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [f"a{i}" for i in range(500)] + [f"b{i}" for i in range(500)]
    assert [(r.line_id, r.value) for r in rows] == list(enumerate(want))


def test_files_come_in_the_order_of_their_numbers(spark, folder):
    for n in (100000, 99999, 2):
        path = folder(f"part-{n}.txt", f"n{n}\n")
    rows = readers.read_lines(spark, path).orderBy("line_id").collect()
    assert [r.value for r in rows] == ["n2", "n99999", "n100000"]


def test_missing_metadata_keys_are_reported(spark):
    saved = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    current = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, v bigint")
    row = runs.check_metadata(saved, current).first()
    assert (row.n, row.report) == (2, "b: ckpt=2 vs actuel=3 | c: ckpt=None vs actuel=4")


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(Conf)
            getCheckpointDir = staticmethod(lambda: None)

        conf = Conf()

    with pytest.raises(ValueError):
        shared_dir(Session)


def test_tokens_and_ids(spark, folder):
    path = folder("ids.txt", "1234 56\n\n -3\t12")
    assert [r.token for r in readers.read_tokens(spark, path).orderBy("doc_id", "pos").collect()] == ["1234", "56", "-3", "12"]
    assert [r.id for r in readers.read_ids(spark, path, 10).orderBy("doc_id", "pos").collect()] == [4, 6, 7, 2]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("separator", [None, " ", "\n", "\t"])
@pytest.mark.parametrize("glue", [" ", "\n", "\t", " \n\t  \r\n", "\u2003 "])
def test_a_line_of_many_splits_is_many_tasks(spark, folder, small_splits, glue, separator):
    words = [f"é{i * 7919 % 1000}" for i in range(1500)]
    text = glue + glue.join(words) + glue
    path = folder("part-10.txt", text)
    folder("part-9.txt", "first of all\n")
    rows = readers.read_word_stream(spark, path, separator)
    assert [(r.gpos, r.token) for r in rows.orderBy("gpos").collect()] == list(enumerate(("first of all " + text).split()))


def test_one_line_is_read_by_as_many_tasks_as_it_has_splits(spark, folder, small_splits):
    path = folder("ids.txt", " ".join(str(i) for i in range(3000)))
    assert readers.word_separator(spark, path) == " "
    lines = spark.read.option("lineSep", " ").text(path)
    tasks = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 10 and max(tasks) < 600
    got = readers.read_id_stream(spark, path, 1000, first=2500).orderBy("gpos").collect()
    assert [(r.gpos, r.id) for r in got] == [(i, i % 1000) for i in range(2500)]


@pytest.mark.parametrize("text, want", [("a b c\nd", " "), ("a\nb\nc d", "\n"), ("a\tb\tc d", "\t"), ("", "\n")])
def test_separator_of_a_file(spark, folder, text, want):
    assert readers.word_separator(spark, folder("x.txt", text)) == want


def test_words_written_without_line_ends(spark, tmp_path):
    path = scratch_path(spark, "words")
    sinks.write_words(spark.range(1000).repartition(7), path, "id", "id")
    import glob

    text = "".join(open(f).read() for f in sorted(glob.glob(path.removeprefix("file:") + "/part-*")))
    assert "\n" not in text and text.split() == [str(i) for i in range(1000)]
    assert [r.id for r in readers.read_id_stream(spark, path).orderBy("gpos").collect()] == list(range(1000))


def test_a_word_that_is_no_number_fails(spark, folder):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_id_stream(spark, folder("ids.txt", "1 x 3")).collect()


def test_vocab_json_roundtrip(spark):
    rows = [('a"b', 0), ("c\\d", 1), ("é,", 2), ("{", 3), ("}", 7)]
    path = scratch_path(spark, "vocab")
    sinks.write_vocab_json(spark.createDataFrame(rows, "token string, id bigint"), path)
    assert sorted(map(tuple, readers.read_vocab_json(spark, path).collect())) == sorted(rows)
    import glob
    import json

    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(path + "/part-*")))
    assert json.loads(text) == dict(rows)


def test_vocab_json_of_other_writers(spark, folder):
    path = folder("v.json", '{\n  "a": 1,\n  "b": 2\n}\n')
    assert sorted(map(tuple, readers.read_vocab_json(spark, path).collect())) == [("a", 1), ("b", 2)]


def test_vocab_json_on_one_line(spark, folder):
    path = folder("v.json", '{"a": 1, "}": 2}')
    assert sorted(map(tuple, readers.read_vocab_json(spark, path).collect())) == [("a", 1), ("}", 2)]


@pytest.mark.parametrize(
    "text", ['{\n"a" 1\n}', "{\nnonsense\n}", "[\n1,\n2\n]", '{\n"a": 1,\n"b": 2,\n', '"a": 1\n}', '{\n"a": 1\n}\n{\n"b": 2\n}']
)
def test_bad_vocab_json_fails(spark, folder, text):
    path = folder("v.json", text)
    with pytest.raises(Exception):
        readers.read_vocab_json(spark, path).collect()


@pytest.mark.parametrize("indent", [None, 2])
def test_vocab_object_on_one_line_is_read_by_many_tasks(spark, folder, small_splits, indent):
    import json

    words = {f'w{i}"' if i % 7 == 0 else f"a,b{{{i}}}," if i % 5 == 0 else f"\\\\{i}:é\\\\" : i for i in range(900)}
    path = folder("v.json", json.dumps(words, indent=indent, ensure_ascii=indent is None) + "\n")
    assert {r.token: r.id for r in readers.read_vocab_object(spark, path).collect()} == words


@pytest.mark.parametrize("text, want", [("{}", []), (' { "a" : 1 } ', [("a", 1)]), ('{"a": 1, "a": 2}', [("a", 1), ("a", 2)])])
def test_small_vocab_objects(spark, folder, text, want):
    assert sorted(map(tuple, readers.read_vocab_object(spark, folder("v.json", text)).collect())) == want


@pytest.mark.parametrize("text", ['{"a" 1}', '{"a": 1', '["a", 1]', '"a": 1}', '{"a": 1,}', '{"a": 1}, {"b": 2}', '{"a": 1,, "b": 2}', '{"a": x}'])
def test_bad_vocab_objects_fail(spark, folder, text):
    with pytest.raises(Exception):
        readers.read_vocab_object(spark, folder("v.json", text)).collect()


def test_labelled_csv_reads_text_and_missing_cells(spark, folder):
    path = folder("d.csv", "texte,classe,pos_tag\nchat,nom,\n12,nombre,num\n")
    rows = [tuple(r) for r in readers.read_labelled(spark, path).collect()]
    assert rows == [("chat", "nom", "nan"), ("12", "nombre", "num")]


def test_lexicon_keeps_header_and_repeats(spark, folder):
    path = folder("noms.csv", "texte\nchat\nchat,x\n")
    assert [r.word for r in readers.read_lexicon(spark, path).collect()] == ["texte", "chat", "chat"]


def test_dialogs_without_a_column(spark):
    path = scratch_path(spark, "dialogs")
    spark.createDataFrame([("bonjour à tous",)], "prompt string").write.parquet(path)
    read = readers.read_dialogs(spark, path)
    assert tuple(read.first()) == ("bonjour à tous", "")
    assert dialogs.dialog_pairs(read).count() == 0


def test_missing_sides_read_as_text_none(spark):
    df = spark.createDataFrame([("a" * 11, None), ("a" * 11, "b" * 11)], "prompt string, response string")
    assert [tuple(r) for r in dialogs.dialog_pairs(df).collect()] == [("a" * 11, "b" * 11)]


def test_choose_dataset(spark):
    small, large = scratch_path(spark, "small"), scratch_path(spark, "large")
    spark.createDataFrame([("a b",)], "text string").write.parquet(small)
    spark.createDataFrame([("a b c d e",)], "text string").write.parquet(large)
    names = [("gone", "/nowhere/x"), ("small", small), ("large", large), ("again", large)]
    rows = readers.choose_dataset(spark, names, 4).orderBy("priority").collect()
    assert [(r.name, r.n, r.reason, r.chosen) for r in rows] == [
        ("gone", 0, "absent", False),
        ("small", 2, "too few", False),
        ("large", 4, "ok", True),
        ("again", 4, "ok", False),
    ]
    none = readers.choose_dataset(spark, names[:2], 4).collect()
    assert not any(r.chosen for r in none)


def turns(spark, roles, conv=1):
    rows = [(conv, t, role, f"{conv}-{t}") for t, role in enumerate(roles)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


@pytest.mark.parametrize("block", [1, 2, 3, 5, 4096])
def test_dialog_turns_over_block_borders(spark, block):
    roles = ["system", "user", "assistant", "user", "user", "system", "assistant", "assistant", "user", "system", "system", "system", "assistant", "user"]
    df = turns(spark, roles).unionByName(turns(spark, ["user", "assistant"], 2)).unionByName(turns(spark, ["user"], 3))
    got = sorted(map(tuple, dialogs.dialog_turns(df, block).collect()))
    assert got == [(1, 1, "1-1", "1-2"), (1, 4, "1-4", "1-6"), (1, 8, "1-8", "1-12"), (2, 0, "2-0", "2-1")]


def test_check_metadata(spark):
    saved = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "k string, v bigint")
    current = spark.createDataFrame([("b", 9), ("a", 7), ("c", 3)], "k string, v bigint")
    assert tuple(runs.check_metadata(saved, current).first()) == (2, "a: ckpt=2 vs actuel=7 | b: ckpt=1 vs actuel=9")


def test_series_mean(spark):
    values = [4.8345, 5.87675, 7.79486, 5.7094, 5.45465, 6.33266, 5.82711, 5.02887, 7.08469, 4.4266, 6.62119, 7.027]
    df = spark.createDataFrame([("one", v) for v in values], "series string, value double")
    row = runs.series_mean(df, "series", "value").first()
    assert row.n == 12 and abs(row["mean"] - 6.0015) < 1e-3 and row.index_mean == 5.5


@pytest.mark.parametrize("files", [0, 1, 3])
def test_a_table_streams_from_one_file_and_from_a_folder(spark, tmp_path, files):
    from pathlib import Path

    from tokenloom.plans.scans import scan_web_stream

    rows = [(i, f"text {i}") for i in range(9)] if files else []
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    if files == 1:
        df.coalesce(1).write.parquet(str(tmp_path / "made"))
        (part,) = Path(tmp_path / "made").glob("*.parquet")
        part.rename(tmp_path / "documents.parquet")
    else:
        df.repartition(max(files, 1)).write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, scan_web_stream(spark, str(tmp_path)).collect())) == rows
