"""Word classes, fuzzy matching and sentences (M, A4-A6, L5, J7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import sentence, split_phrase
from tokenloom.operators import classify, matching, sentences, training, weights
from tokenloom.plans import inputs as I
from tokenloom.plans.registry import query
from tokenloom.session import materialize
from tokenloom.sources.readers import read_table, spread

TRIES = 20  # drawn sentences per text
NEEDED_HITS = 3


def words(spark: SparkSession, d: str) -> DataFrame:
    return I.phrase_words(I.prompts(spark, d))


SQL_WORDS = f"""pwords AS (
  SELECT item_id AS doc_id, unnest(range(len(w))) AS pos, unnest(w) AS word
  FROM (SELECT item_id, {I.SQL_SPLIT_PHRASE.format('text')} AS w FROM benchmark))"""

# Longest common subsequence by bit masks: v keeps a zero bit for each matched letter. Words of
# the tables stay below 64 letters. DuckDB's levenshtein counts bytes; without accents a letter is
# one byte, and dropping accents never makes two words differ more, so no pair is lost.
SQL_MATCHES = f"""{I.LEXICON}, {SQL_WORDS},
uniq AS (SELECT DISTINCT word FROM pwords),
near AS MATERIALIZED (
  SELECT word, row_id, texte, length(word) AS la, length(texte) AS lb FROM uniq JOIN lex
  ON length(texte) * 130 >= length(word) * 70 AND length(word) * 130 >= length(texte) * 70
  AND levenshtein(strip_accents(word), strip_accents(texte)) <= floor((length(word) + length(texte)) * 0.3)),
masks AS (
  SELECT word, row_id, texte, la, lb, list_transform(string_split(texte, ''),
    lambda c: list_sum(list_transform(string_split(word, ''), lambda w, i: CASE WHEN w = c THEN (1::HUGEINT << (i - 1)::INTEGER) ELSE 0::HUGEINT END))::HUGEINT) AS m
  FROM near),
bits AS (
  SELECT word, row_id, texte, la, lb,
    list_reduce(m, lambda v, x: (((v + (v & x)) | (v - (v & x))) & ((1::HUGEINT << la::INTEGER) - 1)), (1::HUGEINT << la::INTEGER) - 1) AS v
  FROM masks),
scored AS (
  SELECT word, row_id, 200.0 * (la - bit_count(v)) / (la + lb) AS score FROM bits),
matched AS (
  SELECT word, row_id, texte, classe, pos_tag, score FROM (
    SELECT word, row_id, score FROM scored WHERE score >= 70
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY score DESC, row_id) = 1)
  JOIN lex USING (row_id))"""


def matches(spark: SparkSession, d: str, lexicon: DataFrame) -> DataFrame:
    return matching.best_match(words(spark, d), lexicon)


@query(
    "fuzzy_match",
    f"WITH {SQL_MATCHES} SELECT word, row_id, texte, classe, pos_tag, round(score, 6) AS score FROM matched",
)
def fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    return matches(spark, d, I.lexicon(spark, d)).withColumn("score", F.round("score", 6))


@query(
    "pos_tag_lookup",
    f"""WITH {SQL_MATCHES}
SELECT doc_id, word, coalesce(pos_tag, 'inconnu') AS pos_tag FROM pwords LEFT JOIN matched USING (word)""",
)
def pos_tag_lookup(spark: SparkSession, d: str) -> DataFrame:
    return matching.pos_tags(words(spark, d), matches(spark, d, I.lexicon(spark, d)))


SQL_TERM_WORDS = "regexp_extract_all(lower({0}), '[a-z0-9_à-öø-ÿ]{{2,}}')"


@query(
    "tfidf",
    f"""WITH t AS (SELECT d.doc_id, {SQL_TERM_WORDS.format('d.text')} AS w FROM documents d),
g AS (
  SELECT doc_id, unnest(list_transform(range(1, (len(w) - n + 2)::BIGINT), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS term
  FROM t, (VALUES (1), (2), (3)) v(n)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
raw AS (
  SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM t)) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term))
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def tfidf(spark: SparkSession, d: str) -> DataFrame:
    return weights.tfidf(I.documents(spark, d), "doc_id").withColumn("weight", F.round("weight", 6))


def labelled_texts(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents; the class is the language."""
    labels = read_table(spark, d, "labels", "doc_id")
    docs = read_table(spark, d, "documents", "doc_id", "text", F.col("lang").alias("classe"))
    return spread(docs, "doc_id").join(labels, "doc_id")


@query("svm_predict")
def svm_predict(spark: SparkSession, d: str) -> DataFrame:
    """Train on the labelled documents, predict every document."""
    model = classify.fit(materialize(labelled_texts(spark, d)))
    docs = read_table(spark, d, "documents", "doc_id", "text", F.col("lang").alias("classe"))
    return model.predict(spread(docs, "doc_id")).select("doc_id", "classe", "predicted")


@query("tag_words")
def tag_words(spark: SparkSession, d: str) -> DataFrame:
    """Every word of the benchmark texts: class by the model, tag by the best match."""
    model = classify.fit(materialize(labelled_texts(spark, d)))
    found = materialize(matches(spark, d, I.lexicon(spark, d)))
    tagged = materialize(classify.tag_words(words(spark, d), model, found))
    return words(spark, d).join(tagged, "word").select("doc_id", "word", "category", "pos_tag")


# Given predictions: the language an unlabelled document uses the word in most.
SQL_GIVEN = f"""given AS (
  SELECT word, lang AS predicted FROM (
    SELECT word, lang, count(*) AS n FROM (
      SELECT d.lang, unnest({I.SQL_SPLIT_PHRASE.format('d.text')}) AS word
      FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)) GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, lang) = 1)"""


def given_predictions(spark: SparkSession, d: str) -> DataFrame:
    labels = read_table(spark, d, "labels", "doc_id")
    docs = spread(read_table(spark, d, "documents", "doc_id", "text", "lang"), "doc_id")
    uses = docs.join(labels, "doc_id", "left_anti").select("lang", F.explode(split_phrase("text")).alias("word"))
    counts = uses.groupBy("word", "lang").agg(F.count("*").alias("n"))
    return counts.groupBy("word").agg(F.min_by("lang", F.struct(-F.col("n"), F.col("lang"))).alias("predicted"))


@query(
    "self_train",
    f"""WITH {SQL_MATCHES}, {SQL_GIVEN}
SELECT texte, classe, pos_tag FROM lex UNION ALL
SELECT word, predicted, NULL FROM matched JOIN given USING (word)
WHERE classe = predicted AND word NOT IN (SELECT texte FROM lex)""",
)
def self_train(spark: SparkSession, d: str) -> DataFrame:
    lexicon = I.lexicon(spark, d)
    new = matching.self_training_rows(matches(spark, d, lexicon), given_predictions(spark, d), lexicon)
    return matching.append_rows(lexicon.select("texte", "classe", "pos_tag"), new)


@query(
    "apply_corrections",
    f"""WITH {I.LEXICON}, {SQL_GIVEN}
SELECT texte, classe, count(*) AS n FROM (
  SELECT texte, classe FROM lex UNION ALL
  SELECT texte, predicted FROM lex JOIN given ON word = texte WHERE classe <> predicted) GROUP BY 1, 2""",
)
def apply_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Corrections only add rows: the corrected word then stands there with both classes."""
    lexicon = I.lexicon(spark, d)
    wrong = lexicon.join(given_predictions(spark, d).withColumnRenamed("word", "texte"), "texte")
    corrections = wrong.filter("classe <> predicted").select("texte", F.col("predicted").alias("classe"))
    both = matching.append_rows(lexicon.select("texte", "classe"), corrections)
    return both.groupBy("texte", "classe").agg(F.count("*").alias("n"))


@query("self_train_refit")
def self_train_refit(spark: SparkSession, d: str) -> DataFrame:
    """Words of the benchmark texts that the model and the best match agree on, with the round that added each, and what
    the last model says of all words."""
    rows, model, _ = training.self_train(words(spark, d), I.lexicon(spark, d))
    named = rows.select("texte", "classe", "pos_tag", "round", F.col("texte").alias("text"))
    return model.predict(named).drop("text")


@query("corrections_refit")
def corrections_refit(spark: SparkSession, d: str) -> DataFrame:
    """What models before and after the corrections say of the corrected words."""
    lexicon = I.lexicon(spark, d)
    wrong = lexicon.join(given_predictions(spark, d).withColumnRenamed("word", "texte"), "texte")
    wrong = materialize(wrong.filter("classe <> predicted").select("texte", F.col("predicted").alias("classe")))
    _, after = training.apply_corrections(lexicon.select("texte", "classe"), wrong)
    said = training.fit_lexicon(lexicon).predict(wrong.withColumn("text", F.col("texte")), "before")
    return after.predict(said, "after").select("texte", "classe", "before", "after")


# Sentences ---------------------------------------------------------------------------------

SLOT_CLASSES = {"pron": "fr", "verbe": "en", "article": "es", "nom": "de"}


def word_lists(lexicon: DataFrame) -> dict[str, DataFrame]:
    """One list per slot: the words of one class, in row order."""
    return {
        slot: lexicon.filter(F.col("classe") == c).select("row_id", F.col("texte").alias("word"))
        for slot, c in SLOT_CLASSES.items()
    }


def categories(lexicon: DataFrame) -> DataFrame:
    """The fixed tag table: words of one or two letters count as articles."""
    short = F.length("texte") <= 2
    return lexicon.select(
        F.col("texte").alias("word"), F.when(short, "article").otherwise(F.col("classe")).alias("category")
    )


SQL_CATEGORIES = """tags AS (
  SELECT texte AS word, CASE WHEN length(texte) <= 2 THEN 'article' ELSE classe END AS category FROM lex)"""


def _sql_pick(rows: str, row: str, slot: str) -> str:
    return f"""pick_{slot} AS (
  SELECT r.*, l.word AS {slot} FROM {rows} r JOIN (
    SELECT texte AS word, row_number() OVER (ORDER BY row_id) - 1 AS place FROM lex WHERE classe = '{SLOT_CLASSES[slot]}') l
  ON l.place = ('0x' || substr(md5(r.{row} || ':{slot}:{I.SEED}'), 1, 8))::BIGINT
             % (SELECT count(*) FROM lex WHERE classe = '{SLOT_CLASSES[slot]}'))"""


@query(
    "random_pick",
    f"""WITH {I.LEXICON}, rows AS (SELECT doc_id FROM {I.TURNS}), {_sql_pick('rows', 'doc_id', 'nom')}
SELECT doc_id, nom FROM pick_nom""",
)
def random_pick(spark: SparkSession, d: str) -> DataFrame:
    rows = I.turns(spark, d).select("doc_id")
    return sentences.pick(rows, word_lists(I.lexicon(spark, d))["nom"], "doc_id", "nom", I.SEED)


SQL_DRAWN = f"""{_sql_pick('tries', 'try', 'pron')}, {_sql_pick('pick_pron', 'try', 'verbe')},
{_sql_pick('pick_verbe', 'try', 'article')}, {_sql_pick('pick_article', 'try', 'nom')},
drawn AS (SELECT doc_id, try, pron || ' ' || verbe || ' ' || article || ' ' || nom AS phrase FROM pick_nom)"""

SQL_TRIES = f"tries AS (SELECT item_id AS doc_id, item_id * {TRIES} + k AS try FROM benchmark, unnest(range({TRIES})) AS u(k))"


def tries(spark: SparkSession, d: str) -> DataFrame:
    """Seeded attempts per benchmark text, all in one pass."""
    k = F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1)))
    items = read_table(spark, d, "benchmark", F.col("item_id").alias("doc_id"))
    return items.withColumn("try", k).withColumn("try", F.col("doc_id") * TRIES + F.col("try"))


def drawn(spark: SparkSession, d: str, lexicon: DataFrame) -> DataFrame:
    lists = word_lists(lexicon)
    return sentences.draw_sentences(tries(spark, d), lists, "try", I.SEED).select("doc_id", "try", "phrase")


@query("sentence_cross", f"WITH {I.LEXICON}, {SQL_TRIES}, {SQL_DRAWN} SELECT doc_id, try, phrase FROM drawn")
def sentence_cross(spark: SparkSession, d: str) -> DataFrame:
    return drawn(spark, d, I.lexicon(spark, d))


@query(
    "sentence_template",
    f"""WITH {SQL_WORDS}
SELECT doc_id, pos // 3 AS number, string_agg(word, ' ' ORDER BY pos) AS phrase
FROM pwords GROUP BY ALL HAVING count(*) = 3""",
)
def sentence_template(spark: SparkSession, d: str) -> DataFrame:
    """Three slots, filled with one three words after the other of each text."""
    split = I.prompts(spark, d).withColumn("w", split_phrase("text")).filter(F.size("w") >= 3)
    starts = F.sequence(F.lit(0), F.size("w") - 3, F.lit(3))
    rows = split.select("doc_id", "w", F.posexplode(starts).alias("number", "at"))
    words = [F.get("w", F.col("at") + i) for i in range(3)]
    return rows.select("doc_id", F.col("number").cast("bigint").alias("number"), sentence(*words).alias("phrase"))


def start_categories(spark: SparkSession, d: str, tags: DataFrame) -> DataFrame:
    return words(spark, d).join(tags, "word").select("doc_id", "category").distinct()


SQL_STARTS = "starts AS (SELECT DISTINCT doc_id, category FROM pwords JOIN tags USING (word))"


@query(
    "distinct_categories",
    f"""WITH {I.LEXICON}, {SQL_CATEGORIES}, {SQL_WORDS}, {SQL_STARTS}
SELECT doc_id, string_agg(category, ' ' ORDER BY category) AS categories FROM starts GROUP BY doc_id""",
)
def distinct_categories(spark: SparkSession, d: str) -> DataFrame:
    starts = start_categories(spark, d, categories(I.lexicon(spark, d)))
    found = F.array_join(F.array_sort(F.collect_set("category")), " ")
    return starts.groupBy("doc_id").agg(found.alias("categories"))


SQL_HITS = f"""{I.LEXICON}, {SQL_CATEGORIES}, {SQL_WORDS}, {SQL_STARTS}, {SQL_TRIES}, {SQL_DRAWN},
parts AS (
  SELECT doc_id, try, phrase, unnest({I.SQL_SPLIT_PHRASE.format('phrase')}) AS word FROM drawn),
hits AS (
  SELECT p.doc_id, p.try, p.phrase, count(s.category) AS hits, coalesce(bool_or(t.category = 'article'), false) AS has_article
  FROM parts p LEFT JOIN tags t USING (word)
  LEFT JOIN starts s ON s.doc_id = p.doc_id AND s.category = t.category GROUP BY 1, 2, 3)"""


def hits(spark: SparkSession, d: str) -> DataFrame:
    lexicon = I.lexicon(spark, d)
    tags = materialize(categories(lexicon))
    phrases = materialize(drawn(spark, d, lexicon))
    wanted = phrases.select("doc_id", "try").join(start_categories(spark, d, tags), "doc_id").select("try", "category")
    return phrases.join(sentences.category_hits(phrases, tags, "try", wanted), "try")


@query("category_hits", f"WITH {SQL_HITS} SELECT try, hits FROM hits WHERE hits >= {NEEDED_HITS}")
def category_hits(spark: SparkSession, d: str) -> DataFrame:
    return hits(spark, d).filter(F.col("hits") >= NEEDED_HITS).select("try", "hits")


@query("article_hit", f"WITH {SQL_HITS} SELECT try, phrase FROM hits WHERE has_article")
def article_hit(spark: SparkSession, d: str) -> DataFrame:
    return hits(spark, d).filter("has_article").select("try", "phrase")


SLOTS = list(SLOT_CLASSES)


def _sql_share(name: str, total: str) -> str:
    return f"(('0x' || substr(md5(doc_id || ':{name}:{I.SEED}'), 1, 8))::BIGINT::HUGEINT * {total}) // 4294967296"


def _sql_accepted(name: str, least: int, flags: dict[str, tuple[str, str]]) -> str:
    """CTE ``name(doc_id, phrase)``; ``flags`` says per slot which kinds of words are accepted."""
    good = [f"(CASE WHEN {flags[s][0]} THEN n_{s}_0 ELSE 0 END + CASE WHEN {flags[s][1]} THEN n_{s}_1 ELSE 0 END)::HUGEINT AS {s}_good" for s in SLOTS]
    patterns = [p for p in range(1 << len(SLOTS)) if p.bit_count() >= least]
    ways = [" * ".join(f"{s}_good" if p >> i & 1 else f"{s}_bad" for i, s in enumerate(SLOTS)) for p in patterns]
    picks, joins = [], []
    for i, s in enumerate(SLOTS):
        hit = f"((pattern >> {i}) & 1 = 1)"
        picks.append(f"{_sql_share(f'{name}-{s}', f'CASE WHEN {hit} THEN {s}_good ELSE {s}_bad END')} AS {s}_place")
        picks.append(f"CASE WHEN {flags[s][0]} = {hit} THEN n_{s}_0 ELSE 0 END AS {s}_first")
        joins.append(f"""JOIN lists l_{s} ON l_{s}.slot = '{s}' AND l_{s}.kind = ({s}_place >= {s}_first)::INT
    AND l_{s}.num = CASE WHEN {s}_place >= {s}_first THEN {s}_place - {s}_first ELSE {s}_place END""")
    return f"""{name}_good AS (SELECT *, {', '.join(good)} FROM docs_flags, list_sizes),
{name}_bad AS (SELECT *, {', '.join(f'n_{s}_0 + n_{s}_1 - {s}_good AS {s}_bad' for s in SLOTS)} FROM {name}_good),
{name}_ways AS (SELECT *, [{', '.join(ways)}] AS ways FROM {name}_bad),
{name}_at AS (
  SELECT *, {_sql_share(name, 'list_sum(ways)::HUGEINT')} AS spot FROM {name}_ways WHERE list_sum(ways) > 0),
{name}_pattern AS (
  SELECT *, [{', '.join(map(str, patterns))}][1 + len(list_filter(range(1, {len(patterns)}),
    lambda i: list_sum(ways[1:i])::HUGEINT <= spot))] AS pattern FROM {name}_at),
{name}_picks AS (SELECT *, {', '.join(picks)} FROM {name}_pattern),
{name} AS (
  SELECT doc_id, {" || ' ' || ".join(f'l_{s}.word' for s in SLOTS)} AS phrase FROM {name}_picks {' '.join(joins)})"""


SQL_LISTS = f"""slot_words AS ({' UNION ALL '.join(f"SELECT '{s}' AS slot, row_id, texte AS word FROM lex WHERE classe = '{c}'" for s, c in SLOT_CLASSES.items())}),
lists AS (
  SELECT slot, (category = 'article')::INT AS kind, word,
         row_number() OVER (PARTITION BY slot, category = 'article' ORDER BY row_id) - 1 AS num
  FROM slot_words JOIN tags USING (word)),
list_sizes AS (SELECT {', '.join(f"count(*) FILTER (slot = '{s}' AND kind = {k}) AS n_{s}_{k}" for s in SLOTS for k in (0, 1))} FROM lists),
docs_flags AS (
  SELECT doc_id, {', '.join(f"coalesce(bool_or(category = '{c}'), false) AS has_{c}" for c in [*SLOT_CLASSES.values(), 'article'])}
  FROM (SELECT item_id AS doc_id FROM benchmark) LEFT JOIN starts USING (doc_id) GROUP BY doc_id)"""


@query(
    "accept_sentences",
    f"""WITH {I.LEXICON}, {SQL_CATEGORIES}, {SQL_WORDS}, {SQL_STARTS}, {SQL_LISTS},
{_sql_accepted('by_hits', NEEDED_HITS, {s: (f'has_{c}', 'has_article') for s, c in SLOT_CLASSES.items()})},
{_sql_accepted('by_article', 1, {s: ('false', 'true') for s in SLOTS})}
SELECT b.item_id AS doc_id, h.phrase AS by_hits, a.phrase AS by_article FROM benchmark b
LEFT JOIN by_hits h ON h.doc_id = b.item_id LEFT JOIN by_article a ON a.doc_id = b.item_id""",
)
def accept_sentences(spark: SparkSession, d: str) -> DataFrame:
    """An accepted sentence per text, by each of the two rules; null only if there is none."""
    lexicon = I.lexicon(spark, d)
    tags = materialize(categories(lexicon))
    numbered = materialize(sentences.numbered_lists(word_lists(lexicon), tags))
    found = start_categories(spark, d, tags).groupBy("doc_id").agg(F.collect_set("category").alias("_found"))
    texts = read_table(spark, d, "benchmark", F.col("item_id").alias("doc_id")).join(found, "doc_id", "left")

    def has(category: str) -> Column:
        return F.coalesce(F.array_contains("_found", category), F.lit(False))

    by_hits = texts.select(
        "doc_id",
        *[has(c).alias(f"{s}_0") for s, c in SLOT_CLASSES.items()],
        *[has(sentences.ARTICLE).alias(f"{s}_1") for s in SLOTS],
    )
    by_article = texts.select(
        "doc_id", *[F.lit(False).alias(f"{s}_0") for s in SLOTS], *[F.lit(True).alias(f"{s}_1") for s in SLOTS]
    )
    out = texts.select("doc_id")
    for name, rows, least in (("by_hits", by_hits, NEEDED_HITS), ("by_article", by_article, 1)):
        drawn_ = sentences.draw_accepted(rows, numbered, SLOTS, "doc_id", name, least, I.SEED)
        out = out.join(drawn_.withColumnRenamed("phrase", name), "doc_id", "left")
    return out
