"""The mix against its SQL and its promises."""

from llm_data import duck_of

from tokenloom.llm import mixing


def test_mix_equals_its_sql_on_odd_rows(spark, odd):
    got = mixing.mix(odd).drop("source")
    con = duck_of(odd, "documents")
    columns = sorted(got.columns)
    want = con.sql(mixing.SQL).select(*columns).fetchall()
    # DuckDB orders a null key otherwise; the null id is the only row of its size in its source.
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


def test_taken_words_meet_the_targets(spark, odd):
    rows = mixing.mix(odd).collect()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for group in by.values():
        assert sum(r.taken for r in group) == int(group[0].target)


def test_documents_of_the_mix_hold_the_taken_words(spark, odd):
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    words = sum(len((r.text or "").split()) for r in mixed.select("text").collect())
    taken = sum(r.taken for r in mixing.mix(odd).collect())
    assert abs(words - taken) <= 1  # rows with the same id share their words evenly


def test_no_documents(nothing):
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


