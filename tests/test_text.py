"""Edge tables for the text functions with their expected values."""

import re

from pyspark.sql import functions as F

from opinari.config import FIXTURE_LEXICON, REFERENCE_LEXICON, Aspect, Lexicon
from opinari.functions import aspects as fa
from opinari.functions import text as tx


T1_ROWS = {
    "see [a\nb] http://x.y/z?q=1 [img]q[/img] ok": "see a b  ok",
    "a \u2603 b": "a  b",
    "a\xa0b\u2003c\u3000d\x85e": "a b c d e",
    "x\xb2 \xbd \xe9 \xe9_\xf1 \u0663": "x\xb2 \xbd \xe9 \xe9_\xf1 \u0663",
    "www.foo imgbar Http://A": "Http:A",
    "[x y]z": "z",
    "": "",
    "   ": "",
    None: "",
    "tab\there\nnew  line": "tab here new line",
    "[open no close": "open no close",
    "a]b[c": "abc",
}


def _col(spark, values, name="t"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_clean_text(spark):
    got = [r[0] for r in _col(spark, list(T1_ROWS)).select(tx.clean_text("t")).collect()]
    assert got == list(T1_ROWS.values())


def test_clean_text_tags_keeps_content(spark):
    rows = ["  [IMG]a[/IMG]  b ", "[URL]x", "plain"]
    got = [r[0] for r in _col(spark, rows).select(tx.clean_text_tags("t")).collect()]
    assert got == ["a b", "x", "plain"]


def test_emails_and_urls(spark):
    rows = {  # text: (without e-mails, without URLs)
        "mail me@ex.org now": ("mail  now", "mail me@ex.org now"),
        "@a@b x": (" x", "@a@b x"),
        "@@@": ("", "@@@"),
        "a@": ("a@", "a@"),
        "ab@\ncd@ef": ("ab@\n", "ab@\ncd@ef"),
        "see https://a.b/c~d ok": ("see https://a.b/c~d ok", "see ~d ok"),
        "u http://x.y/" + "a" * 20000: ("u http://x.y/" + "a" * 20000, "u "),
    }
    got = _col(spark, list(rows)).select(tx.strip_emails("t"), tx.strip_urls("t")).collect()
    assert [tuple(r) for r in got] == list(rows.values())


def test_rating_coercion(spark):
    cases = {"7": 7.0, "7.5": 7.5, " 7 ": 7.0, "N/A": None, "": None, "7d": None, "7f": None,
             "1e3": 1000.0, "nan": None, "0x10": None, "1_0": None, "-3": -3.0, "7,5": None, "+4": 4.0}
    df = _col(spark, list(cases))
    got = [r[0] for r in df.select(tx.coerce_rating("t")).collect()]
    assert got == list(cases.values())


def test_length_rules(spark):
    from opinari.operators import filters
    rows = ["x" * n for n in (9, 10, 11, 5000, 5001)]
    df = _col(spark, rows, "value")
    strict = [len(r[0]) for r in filters.min_length(df, "value", 10).collect()]
    assert strict == [11, 5000, 5001]
    inclusive = [len(r[0]) for r in filters.length_range(df, "value", 10, 5000).collect()]
    assert inclusive == [10, 11, 5000]


def test_sentences_and_words(spark):
    rows = ["Hi. there!! ok?", "...", "   ", "no end mark here"]
    got = [r[0] for r in _col(spark, rows).select(tx.sentence_word_counts("t")).collect()]
    exp = [[len(s.split()) for s in re.split(r"[.!?]+", v) if s.strip()] for v in rows]
    assert got == exp
    w = [r[0] for r in _col(spark, ["Ab, cd_1 é!"]).select(tx.words("t")).collect()]
    assert w == [re.findall(r"\b\w+\b", "ab, cd_1 é!")]


def test_aspects_substring_and_context(spark):
    lex = REFERENCE_LEXICON
    rows = ["you return it", "the waiting is long", "waiting", "bash the leader, stop him",
            "leader target", "luck random rules impact record"]
    got = [r[0] for r in _col(spark, rows).select(fa.extract_aspects(F.col("t"), lex)).collect()]
    assert got[0] == []                      # 'turn' found, but no context word
    assert got[1] == ["downtime"]
    assert got[2] == []
    assert got[3] == ["bash_the_leader"]
    assert got[4] == []                      # context without keyword
    assert got[5] == ["luck", "bookkeeping", "interaction", "complexity"]
    plain = [r[0] for r in _col(spark, ["you return it"]).select(
        fa.extract_aspects(F.col("t"), lex, use_context=False)).collect()]
    assert plain == [["downtime"]]


def test_lower_letters(spark):
    got = spark.createDataFrame([("İI ΑΣ ẞ",)], "t string").select(F.lower("t")).first()[0]
    assert got == "İI ΑΣ ẞ".lower() or got == "i̇i ασ ß"


def test_fixed_length_and_keys(spark):
    df = spark.createDataFrame([(["a", "b"],)], "t array<string>")
    assert df.select(tx.fixed_length("t", 4)).first()[0] == ["a", "b", "<pad>", "<pad>"]
    assert df.select(tx.fixed_length("t", 1)).first()[0] == ["a"]
    import hashlib
    k = spark.createDataFrame([("héllo", ["b", "a"])], "t string, a array<string>") \
        .select(tx.text_key("t"), tx.absa_key("t", "a")).first()
    assert k[0] == hashlib.md5("héllo".encode()).hexdigest()
    assert k[1] == hashlib.md5("héllo_a_b".encode()).hexdigest()


def test_lexicon_scorer(spark):
    from opinari.config import FIXTURE_SCORER
    from opinari.functions.sentiment import lexicon_score
    rows = ["that with", "this from", "that this", None, "  "]
    got = [tuple(r[0]) for r in _col(spark, rows).select(lexicon_score(F.col("t"), FIXTURE_SCORER)).collect()]
    assert got[0][0] == "positive" and abs(got[0][1] - 1 / (1 + 2.718281828459045 ** -2)) < 1e-9
    assert got[1][0] == "negative"
    assert got[2] == ("negative", 0.5)       # tie goes to the lower class
    assert got[3] == ("unknown", 0.0) and got[4] == ("unknown", 0.0)


def test_custom_lexicon_roundtrip():
    lex = Lexicon((Aspect("a", ("x",), (("y",),)),))
    assert lex.without_context().aspects[0].context == ()
    assert FIXTURE_LEXICON.names == ["plain_a", "plain_b", "ctx_wait", "ctx_lead"]


SENTENCE_ROWS = ["Hi. there!! ok?", "...", "   ", "no end mark", None, "", "a.b c", " . a", ".a",
                 "x?!  \n y z.", "one two. 　 .three", "?", "a" * 50 + "." + " " * 30]


def _py_sentence_totals(text):
    parts = [p for p in re.split(r"[.!?]+", text or "") if p.strip()]
    return len(parts), sum(len(p.split()) for p in parts)


def test_sentence_totals_equal_array_form(spark):
    n, w = tx.sentence_totals(F.col("t"))
    arr = tx.sentence_word_counts(F.col("t"))
    rows = _col(spark, SENTENCE_ROWS).select(
        n.alias("n"), w.alias("w"), F.size(arr).alias("an"),
        F.aggregate(arr, F.lit(0), lambda a, x: a + x).alias("aw")).collect()
    for text, r in zip(SENTENCE_ROWS, rows):
        assert (r.n, r.w) == (r.an, r.aw) == _py_sentence_totals(text), text


def test_sentence_totals_on_documents(spark):
    from tests.conftest import SF_SMALL
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    n, w = tx.sentence_totals(F.col("text"))
    arr = tx.sentence_word_counts(F.col("text"))
    bad = d.select(((n != F.size(arr)) | (w != F.aggregate(arr, F.lit(0), lambda a, x: a + x)))
                   .alias("bad")).filter("bad").count()
    assert bad == 0


def test_ws_chars_are_python_whitespace():
    py_ws = {chr(c) for c in range(0x110000) if re.match(r"\s", chr(c))}
    assert set(tx.WS_CHARS) == py_ws and len(tx.WS_CHARS) == len(py_ws)


def test_jvm_whitespace_class_equals_python(spark):
    cps = [*range(0, 0x3101), 0x10000, 0x1F600, 0xFEFF, 0x180E, 0x200B]
    rows = [(c, chr(c)) for c in cps if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame(rows, "cp int, ch string")
    got = {r.cp for r in df.filter(F.col("ch").rlike(f"^[{tx.JWS}]$")).collect()}
    assert got == {c for c, ch in rows if re.match(r"\s", ch)}


def test_stripped_shorter_equals_the_length_of_the_stripped_text(spark):
    rows = [None, "", " ", "\t\n ", "a", " a ", "ab", " a b\x1c", "abcdefghi", " abcdefghij\n", "a" + " " * 5000, "\U0001F600" * 9,
            "\U0001F600" * 10, "a\nb\nc\nd\ne", "a" * 8 + " " * 50, "a        b"]
    df = _col(spark, rows)
    for n in (0, 1, 2, 3, 10):
        got = df.select(tx.stripped_shorter("t", n), F.length(tx.strip_ws("t")) < n).collect()
        assert [r[0] for r in got] == [r[1] for r in got]


def test_emails_go_with_and_without_a_mark(spark):
    rows = {"Mail me@ex.org now": "mail  now", "no MARK here": "no mark here", "[IMG]a@b[/IMG] x": " x", "a@ b": "a b", None: ""}
    assert [r[0] for r in _col(spark, list(rows)).select(tx.deep_clean_text("t")).collect()] == list(rows.values())
