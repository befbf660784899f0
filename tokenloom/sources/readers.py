"""Scans. Every reader names its schema, and ordered text comes with an order key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import compress_id, split_ws
from tokenloom.session import SPREAD, scratch_path

HEAD_BYTES = 65_536
LABELLED = "texte string, classe string, pos_tag string"


def read_table(spark: SparkSession, folder: str, name: str, *columns: str | Column) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a table out by ``key``, only if the session asks for it (see ``session.SPREAD``)."""
    parts = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(parts), key) if parts else df


def read_stream(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    """Lazy scan of a growing parquet folder, or of one file that is named by a pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """Lazy scan of a table, be it one file or a folder of files.

    A stream takes a plain path for a folder; a pattern, even one that only this name fits, may be either.
    """
    return read_stream(spark, f"{folder}/{name}.parque[t]", schema)


def read_dialogs(spark: SparkSession, path: str) -> DataFrame:
    """``(prompt, response)``; a column that the file lacks reads as empty text."""
    df = spark.read.parquet(path)
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit("")).cast("string").alias(c) for c in ("prompt", "response")]
    )


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """CSV of labelled words; an empty cell becomes the text ``nan``."""
    df = spark.read.schema(LABELLED).option("header", True).csv(path)
    return df.select(*[F.coalesce(c, F.lit("nan")).alias(c) for c in ("texte", "classe", "pos_tag")])


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """First CSV column as ``word``: the header row and repeated words stay."""
    return spark.read.csv(path).select(F.col("_c0").alias("word"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_id, value)`` with lines numbered 0, 1, 2, ... over files in name order.

    Names sort by the numbers in them, so ``part-100000`` follows ``part-99999``. A split gives
    its lines rising row numbers without gaps, so a line's place in its split is its row number less
    the split's first. Only one row per split is shuffled and summed; lines meet those offsets in a join
    on the split, never in a sort.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )
    splits = lines.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy(_in_order("_file"), "_block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    offsets = splits.select("_file", "_block", offset.alias("_offset"))
    return lines.join(offsets, ["_file", "_block"]).select((F.col("_offset") + F.col("_row")).alias("line_id"), "value")


def _in_order(file: str) -> Column:
    """Text by which file names sort by the numbers in them: runs of digits get a fixed width."""
    padded = F.transform(
        F.regexp_extract_all(file, F.lit(r"\d+|\D+"), F.lit(0)),
        lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 40, "0")).otherwise(x),
    )
    return F.array_join(padded, "")


def word_separator(spark: SparkSession, path: str) -> str:
    """The character that most often parts words at the head of the first file: a blank, a line end or a tab.

    Only where a file may be cut depends on it, never what is read.
    """
    jvm, where = spark._jvm, path
    fs = jvm.org.apache.hadoop.fs.Path(where).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [s for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(where)) or []]
    files = [s.getPath() for f in found for s in (fs.listStatus(f.getPath()) if f.isDirectory() else [f])]
    files = sorted(str(f) for f in files if not f.getName().startswith(("_", ".")))
    if not files:
        return "\n"
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(files[0]))
    try:
        head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEAD_BYTES)))
    finally:
        stream.close()
    return max("\n \t", key=lambda c: head.count(c.encode()))


def read_word_stream(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """``(gpos, token)``: all words of the files in name order, numbered 0, 1, 2, ... as one stream.

    It equals ``text.split()`` of the files' joined text, as long as each file ends a word. A file of one line is
    cut like any other: records end at ``separator`` (found by :func:`word_separator` if not given), so a line of 100 GB is many
    tasks, and white space of other kinds is split inside the records.

    Words are stored once, numbered as they are read; a word's place in its split is this number less that of the split's
    first word. Only one row per split is summed up, and its sum meets the words by broadcast.
    """
    records = spark.read.option("lineSep", separator or word_separator(spark, path)).text(path)
    words = records.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.explode(_record_words("value")).alias("token"),
    ).withColumn("_row", F.monotonically_increasing_id())
    # Stored, as a second scan might cut the files elsewhere once executors come or go.
    path = scratch_path(spark, "words")
    words.write.parquet(path)
    words = spark.read.schema(words.schema).parquet(path)
    splits = words.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy(_in_order("_file"), "_block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    offsets = splits.select("_file", "_block", offset.alias("_offset"))
    placed = words.join(F.broadcast(offsets), ["_file", "_block"])
    return placed.select((F.col("_offset") + F.col("_row")).alias("gpos"), "token")


def _record_words(record: str) -> Column:
    """Words of a record, which mostly is one: plain characters alone need no splitting."""
    return F.when(F.col(record).rlike(r"\A[!-~]+\z"), F.array(record)).otherwise(split_ws(record))


def read_id_stream(
    spark: SparkSession, path: str, limit: int | None = None, first: int | None = None, separator: str | None = None
) -> DataFrame:
    """``(gpos, id)`` of ID files, the first ``first`` only if given; ids are folded into ``limit``. A word that is no number fails the job."""
    words = read_word_stream(spark, path, separator)
    number = F.col("token").cast("bigint")
    ids = words.select("gpos", (compress_id(number, limit) if limit else number).alias("id"))
    return ids.filter(F.col("gpos") < first) if first is not None else ids


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, pos, token)`` of a token file; ``doc_id`` is the line number."""
    return read_lines(spark, path).select(
        F.col("line_id").alias("doc_id"), F.posexplode(split_ws("value")).alias("pos", "token")
    )


def read_ids(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``(doc_id, pos, id)`` of an ID file; ids are folded into ``limit`` if given."""
    tokens = read_tokens(spark, path)
    number = F.col("token").cast("bigint")
    return tokens.select("doc_id", "pos", (compress_id(number, limit) if limit else number).alias("id"))


def read_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """``(token, id)`` of a JSON object that is written with one entry per line.

    Such a file can be split, which one JSON value cannot. The job fails on any line that is no
    entry, and on a file without exactly one opening and one closing brace, as one cut short is.
    An object on a single line is read too. Repeated keys all come through.
    """
    text = F.trim(F.col("value"))
    lines = spark.read.text(path).select(text.alias("line"))
    one_line = F.col("line").startswith("{") & F.col("line").endswith("}") & (F.length("line") > 1)
    opened, closed = F.col("line").startswith("{"), F.col("line").endswith("}")
    whole = lines.agg(F.count_if(opened).alias("o"), F.count_if(closed).alias("c")).select(
        ((F.col("o") == 1) & (F.col("c") == 1)).alias("whole")
    )
    entry = F.when(one_line, F.expr("substring(line, 2, length(line) - 2)")).otherwise(
        F.regexp_replace("line", "^,|,$", "")
    )
    entries = lines.select(entry.alias("entry"), whole.scalar().alias("whole"))
    cut = F.raise_error(F.lit("not a whole vocabulary: one { and one } are needed"))
    entries = entries.withColumn("entry", F.when(F.col("whole"), F.col("entry")).otherwise(cut.cast("string")))
    entries = entries.filter(~F.trim("entry").isin("{", "}", ""))
    parsed = F.from_json(
        F.concat(F.lit("{"), "entry", F.lit("}")), "map<string,bigint>", {"mode": "FAILFAST"}
    )
    pairs = entries.select("entry", F.explode_outer(parsed).alias("token", "id"))
    bad = F.raise_error(F.concat(F.lit("not a vocabulary entry: "), "entry"))
    return pairs.select("token", F.when(F.col("id").isNull(), bad.cast("bigint")).otherwise(F.col("id")).alias("id"))


def read_vocab_object(spark: SparkSession, path: str) -> DataFrame:
    """``(token, id)`` of one JSON object per file, laid out in any way, on a single line too, read in as many tasks as the file has splits.

    Records end at commas. One that begins inside a string goes on with the entry of the record before: whether it does is told by
    how many quotes stand before it, summed up over splits and then inside each, and so is the number of its entry. The
    job fails on a file that isn't one whole object and on an entry that is none. Repeated keys all come through.
    """
    records = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value"
    ).withColumn("_row", F.monotonically_increasing_id())
    stored = scratch_path(spark, "records")
    records.write.parquet(stored)
    records = spark.read.schema(records.schema).parquet(stored)
    bare = F.regexp_replace("value", r"\\(?s:.)", "")
    records = records.withColumn("_quotes", F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))))

    def sums(value: str, out: str, rows: DataFrame) -> DataFrame:
        """Add ``out``, the sum of ``value`` before each record of its file: per split first, then inside the split."""
        before = Window.rowsBetween(Window.unboundedPreceding, -1)
        splits = rows.groupBy("_file", "_block").agg(F.sum(value).alias("_sum"))
        far = F.coalesce(F.sum("_sum").over(before.partitionBy("_file").orderBy("_block")), F.lit(0))
        starts = splits.select("_file", "_block", far.alias("_far"))
        near = F.coalesce(F.sum(value).over(before.partitionBy("_file", "_block").orderBy("_row")), F.lit(0))
        return rows.withColumn("_near", near).join(starts, ["_file", "_block"]).withColumn(out, F.col("_near") + F.col("_far")).drop("_near", "_far")

    told = sums("_quotes", "_before", records)
    begins = (F.col("_before") % 2 == 0).cast("bigint")
    entries = sums("_begins", "_earlier", told.withColumn("_begins", begins))
    entries = entries.withColumn("_entry", F.col("_earlier") + F.col("_begins") - 1)
    pieces = F.sort_array(F.collect_list(F.struct("_block", "_row", "value")))
    whole = entries.groupBy("_file", "_entry").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), ",").alias("entry"))
    last = entries.groupBy("_file").agg(F.max("_entry").alias("_last"))
    whole = whole.join(F.broadcast(last), "_file").withColumn("entry", F.regexp_replace("entry", r"^\s+|\s+$", ""))
    first_one, last_one = F.col("_entry") == 0, F.col("_entry") == F.col("_last")
    cut = F.raise_error(F.lit("not a whole vocabulary: one object is needed")).cast("string")
    opened = F.when(~first_one, F.col("entry")).when(F.col("entry").startswith("{"), F.expr("substring(entry, 2)")).otherwise(cut)
    whole = whole.withColumn("entry", opened)
    closed = F.when(~last_one, F.col("entry")).when(F.col("entry").endswith("}"), F.expr("substring(entry, 1, length(entry) - 1)")).otherwise(cut)
    whole = whole.withColumn("entry", closed).filter(~((F.col("_last") == 0) & (F.trim("entry") == "")))
    parsed = F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), "map<string,bigint>", {"mode": "FAILFAST"})
    pairs = whole.select("entry", F.explode_outer(parsed).alias("token", "id"))
    bad = F.raise_error(F.concat(F.lit("not a vocabulary entry: "), "entry"))
    return pairs.select("token", F.when(F.col("id").isNull(), bad.cast("bigint")).otherwise(F.col("id")).alias("id"))


def enough_ids(df: DataFrame, minimum: int) -> DataFrame:
    """One row ``n``: the number of rows, counted up to ``minimum`` only."""
    return df.limit(minimum).agg(F.count("*").alias("n"))


def choose_dataset(
    spark: SparkSession, candidates: list[tuple[str, str]], minimum: int
) -> DataFrame:
    """``(priority, name, n, reason, chosen)`` for candidate parquet paths in order.

    The first one with at least ``minimum`` tokens is chosen. A sample up to ``minimum`` decides,
    so a large file is not counted.
    """
    rows = []
    for priority, (name, path) in enumerate(candidates):
        try:
            table = spark.read.parquet(path)
            sample = enough_ids(table.select(F.explode(split_ws("text"))), minimum)
            found = sample.select("n", F.when(F.col("n") < minimum, "too few").otherwise("ok").alias("reason"))
        except AnalysisException as error:
            reason = "absent" if error.getCondition() == "PATH_NOT_FOUND" else "unreadable"
            found = spark.range(1).select(F.lit(0).cast("bigint").alias("n"), F.lit(reason).alias("reason"))
        rows.append(found.select(F.lit(priority).alias("priority"), F.lit(name).alias("name"), "n", "reason"))
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    first = report.filter("reason = 'ok'").agg(F.min("priority").alias("first")).scalar()
    return report.withColumn("chosen", F.coalesce(F.col("priority") == first, F.lit(False)))
