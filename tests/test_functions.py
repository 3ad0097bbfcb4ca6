"""Golden micro-tests for the scalar rules and the quirks kept on purpose."""

from pyspark.sql import functions as F

from bookmart.functions import catalogue as C
from bookmart.functions import jsoncols as J
from bookmart.functions import text as X
from bookmart.plans import clean, model

from .conftest import rows


def one_col(spark, values, name="v", t="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {t}")


def test_publisher_strip_removes_last_char(spark):   # Q1
    df = one_col(spark, ["Penguin", "Penguin.", "[s.n.]", "Harper, etc.", "Foo?"])
    got = dict(df.select("v", X.normalise_publisher("v").alias("p")).collect())
    assert got == {"Penguin": "Pengui", "Penguin.": "Penguin", "[s.n.]": "",
                   "Harper, etc.": "Harper,", "Foo?": "Foo"}
    alt = dict(df.select("v", X.normalise_publisher("v", C.PUBLISHER_STRIP_DOT_ONLY)
                         .alias("p")).collect())
    assert alt["Penguin"] == "Penguin" and alt["Penguin."] == "Penguin"


def test_publisher_validity(spark):
    df = one_col(spark, ["ab", "abc house", "", "printed by smith", "x" * 90 + "abc", "Pengui"])
    got = [r.v for r in df.filter(X.is_valid_publisher("v")).collect()]
    assert sorted(got) == ["Pengui", "abc house"]


def test_entity_id_no_match_is_empty_not_null(spark):   # Q5
    df = one_col(spark, ["/works/OL12W", "bad-key", None])
    got = dict(df.select("v", X.entity_id("v").alias("id")).collect())
    assert got == {"/works/OL12W": "OL12W", "bad-key": "", None: None}


def test_years_and_parts(spark):   # Q13, F15, F16, F3
    df = one_col(spark, [None, "undated", "0987", "March 2000", "2001", "c. 1999?"])
    got = dict(df.select("v", X.first_year("v").alias("y")).collect())
    assert got == {None: None, "undated": None, "0987": 987, "March 2000": 2000,
                   "2001": 2001, "c. 1999?": 1999}
    y = spark.createDataFrame([(2000,), (2001,), (1999,), (1000,)], "y int")
    parts = {r.y: (r.d, r.c) for r in y.select("y", X.decade("y").alias("d"),
                                               X.century("y").alias("c")).collect()}
    assert parts == {2000: (2000, 20), 2001: (2000, 21), 1999: (1990, 20), 1000: (1000, 10)}


def test_subject_rules(spark):   # Q2, Q9, Q10, Q11
    works = spark.createDataFrame([
        ("/works/OL1W", "t", "1990", 1, '["Fiction, general", "genre:Drama"]', "[]"),
        ("/works/OL2W", "t", "1991", 1, None, "[]"),
        ("/works/OL3W", "t", "1992", 1, '["a\\\\b", "year 1990", " - ", "telecom", "x.com"]', "[]"),
        ("/works/OL4W", "t", None, 1, "[]", "[]"),
    ], "key string, title string, first_publish_year string, edition_count bigint, "
       "subject string, authors string")
    wc = clean.work_clean(works)
    got = rows(wc, "work_id", "subject")
    assert got == [("OL1W", "Drama"), ("OL1W", "Fiction"), ("OL1W", "general"),
                   ("OL3W", ""), ("OL3W", "telecom")]
    # OL2W (null subject) and OL4W (empty list) are gone from every work table
    assert {r.work_id for r in model.dim_work(wc).collect()} == {"OL1W", "OL3W"}


def test_work_median_fill(spark):   # A2, A2b
    works = spark.createDataFrame([
        (f"/works/OL{i}W", "t", y, 1, '["Drama"]', "[]")
        for i, y in enumerate(["1990", "2000", None, "bad", "2010"])],
        "key string, title string, first_publish_year string, edition_count bigint, "
        "subject string, authors string")
    got = dict(clean.work_clean(works).select("work_id", "first_publish_year").collect())
    assert got == {"OL0W": 1990, "OL1W": 2000, "OL2W": 2000, "OL3W": 2000, "OL4W": 2010}


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "k string, y int")
    from bookmart.operators import impute
    assert [r.y for r in impute.fill_median(df, ["y"]).collect()] == [None, None]


def test_languages(spark):   # Q4
    e = one_col(spark, [None, "[]", '[{"key":"/languages/eng"}]', '[{"key":"/languages/lat"}]',
                        '[{"key":"/languages/123"}]', "unknown"], "languages")
    code = F.coalesce(X.language_code(J.first_key("languages")), F.lit(C.UNKNOWN))
    got = [r.l for r in e.select(X.language_label(code).alias("l")).collect()]
    assert got == ["Unknown", "Unknown", "English", None, None, "Unknown"]


def test_json_first_key_and_bad_json(spark):   # F9
    e = one_col(spark, ['[{"key":"/works/OL1W"},{"key":"/works/OL2W"}]', "[]", "unknown", None])
    assert [r.k for r in e.select(J.first_key("v").alias("k")).collect()] == \
        ["/works/OL1W", None, None, None]


def test_link_shapes(spark):   # Q15, F21
    from bookmart.sources import landing
    recs = spark.createDataFrame([
        ("w1", '[{"key":"/authors/OL1A"}]'),
        ("w2", '[{"author":{"key":"/authors/OL2A"},"type":"x"}]'),
        ("w3", '[{"name":"no key"}]'),
        ("w4", None)], "id string, authors string")
    assert rows(landing.linked_keys(recs, "id", "authors")) == [
        ("w1", "/authors/OL1A"), ("w2", "/authors/OL2A")]


def test_author_hash_year_is_deterministic(spark):   # Q8, F18
    a = spark.createDataFrame([
        ("/authors/OL1A", "Ann", None), ("/authors/OL1A ", "Ann", None),
        ("/authors/OL2A", "n/a", "1900"), ("/authors/OL3A", None, "1900"),
        ("/authors/OL4A", "Bo", "born 1901")], "key string, name string, birth_date string")
    ac = clean.author_clean(a)
    d = model.dim_author(ac).collect()
    assert len(d) == 2                       # both OL1A copies collapse
    years = {r.author_id: r.birth_date for r in d}
    assert years["OL4A"] == 1901
    assert 1800 <= years["OL1A"] < 2000
    again = {r.author_id: r.birth_date for r in clean.author_clean(a).collect()}
    assert again["OL1A"] == years["OL1A"]


def test_title_filter_keeps_unknown(spark):   # Q20
    df = one_col(spark, [None, "1234", "Book 1", "Ωμέγα"], "title")
    from bookmart.operators import impute
    got = [r.title for r in impute.fill_constants(df, {"title": "unknown"})
           .filter(X.has_latin_letter("title")).collect()]
    assert sorted(got) == ["Book 1", "unknown"]


def test_name_filter_is_case_sensitive_substring(spark):   # Q21
    df = one_col(spark, ["n/a", "Ann n/a", "N/A", None, "Bo"])
    assert sorted(r.v for r in df.filter(X.is_real_name("v")).collect()) == ["Bo", "N/A"]


def test_nested_to_json(spark):   # S10
    df = spark.createDataFrame([("a", [1, 2], {"k": "v"})], "id string, xs array<int>, m map<string,string>")
    out = J.nested_to_json(df).collect()[0]
    assert out.xs == "[1,2]" and out.m == '{"k":"v"}' and out.id == "a"


EDITION_DDL = ("key string, works string, title string, publish_date string, publishers string, "
               "languages string, number_of_pages bigint, isbn_13 string")


def test_edition_chain_quirks(spark):   # Q3, Q4, Q6, Q13, P9, A2b, P11
    raw = spark.createDataFrame([
        ("/books/OL1M", '[{"key":"/works/OL1W"}]', "Alpha", "May 1, 2001", '["Penguin."]',
         '[{"key":"/languages/eng"}]', 100, "x"),
        ("/books/OL2M", "[]", None, "0987", None, None, None, "x"),
        ("/books/OL3M", '[{"key":"/works/OL3W"}]', "1234", "2001", '["Harper"]', "[]", 300, "x"),
        ("/books/OL4M", '[{"key":"/works/OL4W"}]', "Beta", None, '["Foo Press", "[s.n.]"]',
         '[{"key":"/languages/lat"}]', 200, "x"),
        ("/books/OL5M", '[{"key":"/works/OL5W"}]', "Gamma", "undated 1999", '["Acme house"]',
         '[{"key":"/languages/vie"}]', 50, "x"),
    ], EDITION_DDL)
    ec = clean.edition_clean(raw)
    got = {r.edition_id: r for r in ec.collect()}
    assert set(got) == {"OL1M", "OL2M", "OL4M", "OL5M"}          # '1234' has no letter
    assert got["OL2M"].title == "unknown" and got["OL2M"].work_id is None
    assert got["OL2M"].publish_date == 987                        # '0987' is a year < 1000
    # medians over all parsed rows (before the title filter): years 2001, 987, 2001, 1999
    assert got["OL4M"].publish_date == 1999
    assert got["OL2M"].number_of_pages == 100                     # pages 100, 300, 200, 50
    t = model.dim_time(ec)
    assert rows(t, "publish_year", "time_id") == [(1999, 1), (2001, 2)]   # 987 dropped
    f = {r.edition_id: r.time_id for r in model.fact_book(ec, t).collect()}
    assert f == {"OL1M": 2, "OL2M": None, "OL4M": 1, "OL5M": 1}
    d = rows(model.dim_edition(ec), "edition_id", "publisher", "language")
    # OL2M ('unknown' publishers) is absent; [s.n.] is dropped; 'Foo Press' loses its last char
    assert d == [("OL1M", "Penguin", "English"), ("OL4M", "Foo Pres", None),
                 ("OL5M", "Acme hous", "Vietnamese")]


def test_lookup_map_from_a_table(spark, monkeypatch):   # F14
    codes = spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "b2"), (None, "x")], "code string, name string")
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    got = df.select("k", X.lookup(X.lookup_map(codes, "code", "name"), "k").alias("v"))
    assert rows(got) == [(None, None), ("a", "A"), ("b", "B"), ("c", None)]
    monkeypatch.setattr(X, "MAP_ROWS", 1)
    import pytest
    with pytest.raises(Exception, match="join the table"):
        df.select(X.lookup(X.lookup_map(codes, "code", "name"), "k")).collect()


def test_pages_of_any_shape(spark):   # S9
    from pyspark.sql import types as T

    from bookmart.session import scratch_path
    from bookmart.sources import landing
    path = scratch_path(spark, "t-pages")
    lines = ['{"works": [{"key": "/works/1", "n": 3}, {"key": "/works/2", "n": "x", "more": [1]}], "size": 2}',
             '{"entries": [{"key": "/books/1"}], "works": null}', '{"subjects": []}', '{"entries": {"key": "no list"}}',
             '{"works": [{"key": "/works/3", "n":', "", "[]", "null", '{"works": [5, null, {"key": 7}]}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    record = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.LongType())])
    records, rejects = landing.read_pages(spark, path, record)
    assert rows(records) == [("entries", "/books/1", None), ("works", None, None), ("works", None, None), ("works", "/works/1", 3),
                             ("works", "/works/2", None), ("works", "7", None)]
    assert rows(rejects, "reason") == [("no JSON",)] * 2 + [("no known list",)] * 3
