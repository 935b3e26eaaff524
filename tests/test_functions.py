"""Expressions against plain Python."""

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import candidates as C
from tidemark.functions import dates as D
from tidemark.functions import evidence as E
from tidemark.functions import grants as G
from tidemark.functions import numbers as N
from tidemark.functions import research as R
from tidemark.functions import text as X
from tidemark.functions import urls as U

TEXTS = ["plain", "", "smart “quotes” — dash…", "café über straße", "ﬁne ½ ™", "日本語 한국",
         "naïve é decomposed", "a b", "Ελλάδα Россия", "emoji 😀!", "→ ← ×−"]


def python_clean(text):
    for a, b in K.CLEANING_SUBSTITUTIONS.items():
        text = text.replace(a, b)
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return text.encode("ascii", "replace").decode()


def python_ingest(text):
    out = ""
    for c in text:
        if c.isascii():
            out += c
        elif c in K.INGEST_SUBSTITUTIONS:
            out += K.INGEST_SUBSTITUTIONS[c]
        else:
            out += "".join(d for d in unicodedata.normalize("NFKD", c) if d.isascii())
    return out


def test_ascii_policies(one):
    assert one(X.ascii_clean, TEXTS) == [python_clean(t) for t in TEXTS]
    assert one(X.ascii_ingest, TEXTS) == [python_ingest(t) for t in TEXTS]
    assert one(X.ascii_mask, ["aé日"]) == ["a??"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=50,
                max_size=80))
def test_ascii_policies_on_any_text(one, texts):
    texts = [t.replace("\0", "") for t in texts]
    assert one(X.ascii_clean, texts) == [python_clean(t) for t in texts]
    assert one(X.ascii_ingest, texts) == [python_ingest(t) for t in texts]
    assert one(X.strip, texts) == [t.strip() for t in texts]


def test_ascii_items_keep_nulls(one):
    got = one(X.ascii_ingest_items, [["é", None, ""], [], None], "array<string>")
    assert got == [["e", None, ""], [], None]


def test_normalise_text_is_idempotent(one):
    raw = ["  a\r\nb\rc  ", " x ", " y "]
    once = one(X.normalise_text, raw)
    assert once[0] == "a\nb\nc"
    assert one(X.normalise_text, once) == once


def python_repair(text):
    if text.isascii():
        return text
    try:
        return text.encode("cp1252").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return text


def test_mojibake(one):
    broken = ["→ x".encode().decode("cp1252", "ignore"), "é".encode().decode("cp1252"),
              "café", "plain", "日本", "Ã", "â€™s", "\x81é"]
    assert one(X.repair_mojibake, broken) == [python_repair(t) for t in broken]
    assert one(X.detect_mojibake, ["Ã©", "é", "plain"]) == ["é", None, None]


def test_summary(one):
    text = "word " * 100
    got = one(X.summary, [text, "  short\n text ", "x" * 500, "", None])
    assert got[0] == ("word " * 80)[:399] + "..." and len(got[0]) == 402
    assert got[1] == "short text"
    assert got[2] == "x" * 400 + "..."
    assert got[3:] == ["", ""]


def test_slugs(one):
    assert one(X.model_slug, ["X", "X+", "X++", "X#", "é", "--"]) == [
        "x", "x_plus", "x_plusplus", "x_sharp", "e", "unnamed"]
    assert one(X.lab_slug, [" A&B ", "c.ai", "d+"]) == ["a_and_b", "c_dot_ai", "d_plus"]
    assert one(lambda c: X.event_slug(F.lit("LessWrong"), c), ["Ab-- c" + "9" * 30]) == [
        "lesswrong_ab_c" + "9" * 10]


def test_tokens(one):
    assert one(X.title_tokens, ["The New AI lab, a lab of 2 Models"]) == [["lab", "models"]]
    assert one(X.tag_tokens, ["The x-risk of risk: bias bias a1"]) == [["x-risk", "bias", "bias"]]


def test_drop_tracking(one):
    urls = ["https://a/b?utm_source=x&q=1&utm_term=", "https://a/b?utm_campaign=1", "https://a ",
            "https://a/?x=1?y=2&utm_sourcey=3", ""]
    want = ["https://a/b?q=1", "https://a/b", "https://a", "https://a/?x=1?y=2&utm_sourcey=3", ""]
    assert one(U.drop_tracking, urls) == want
    assert one(U.drop_tracking, want) == want


def test_split_cell(one):
    cells = ["https://a, https://b", "https://a;https://b", "https://a\n\nhttps://b or",
             "https://a (withdrawn) code: https://c/d.", "x.org/abs/1", "vs.something prose",
             "https://a https://a,", "", None, "Doe, J. and Roe"]
    assert one(U.split_cell, cells) == [
        ["https://a", "https://b"], ["https://a;https://b"], ["https://a", "https://b"],
        ["https://a", "https://c/d."], ["https://x.org/abs/1"], [], ["https://a"], [], [], []]


def test_dates(one):
    given = ["2024-03-04", "2024-03-04T01:02:03Z", "2024/3/4", "03/04/2024", "13/04/2024",
             "2024-3-4", "soon", "", None, "2024-13-01", "2024-03-04T1:2:3"]
    want = ["2024-03-04", "2024-03-04T01:02:03Z", "2024-03-04", "2024-03-04", "2024-04-13",
            "2024-03-04", "soon", "", None, "2024-13-01", "2024-03-04"]
    assert one(D.normalise, given) == want
    assert one(D.grant_date, ["March 4, 2024", "Mar 4, 2024", "4 March 2024", "4 Mar 2024",
                              "May 1, 2020", "2024/03/04", "x"]) == [
        "2024-03-04"] * 4 + ["2020-05-01", "2024-03-04", None]
    assert one(D.pad_partial, ["2024", "2024-05", " 2024-05-06 ", "24", ""]) == [
        "2024-01-01", "2024-05-01", "2024-05-06", None, None]
    quarter = D.temporal_fields(F.col("v"))["quarter"]
    assert one(lambda c: quarter, ["2024-12-31", "2024-01-01T00:00:00Z", "2024/01/01"]) == [
        "Q4", "Q1", None]
    assert one(D.year_or, ["1999-01", "", "abcd", None]) == [1999, 2020, 2020, 2020]


def test_partial_dates_compare_on_common_prefix(spark):
    df = spark.createDataFrame([("2015-03", "2015"), ("2014", "2015-06"), ("2015", "2015-06-01")],
                               "a string, b string")
    assert [r[0] for r in df.select(D.precedes(F.col("a"), F.col("b"))).collect()] == [
        False, True, False]


def test_numbers(one):
    assert one(N.parse_number, ["1,234.5", " 7 ", "", "x", None]) == [1234.5, 7.0, None, None, None]
    assert one(N.parse_amount, ["$1,200", "12K", "3M", "3.5m", "abc", "", "1.9"]) == [
        1200, 12000, 3000000, 3500000, None, None, 1]
    logs = one(lambda c: N.transform(c, "log10"), [100.0, 0.0, None], "double")
    assert logs == [2.0, None, None]


def test_quality_and_impacts(one):
    assert one(R.quality_tier, [7.0, 6.9, 4.0, 2.0, 1.9], "double") == ["A", "B", "B", "C", "D"]
    assert one(R.impact_level, [150.0, 149.0, 80.0, 30.0, 29.0], "double") == [
        "Critical", "High", "High", "Medium", "Low"]
    titles = ["[AN #12] x", "Links: y", "our links for May", "Weekly safe review", "normal"]
    assert one(lambda c: R.is_newsletter(c, F.lit("")), titles) == [True] * 4 + [False]


def test_topics_match_substrings(one):
    assert one(lambda c: R.topics(F.lower(c), F.array(F.lit("z"))), ["the wORLd", "GPT policy"]) \
        == [["rl", "z"], ["governance", "llm", "z"]]


def test_description(one):
    def desc(c):
        return X.description(F.lit(None).cast("string"), c, F.lit("T"), unknown="U")
    got = one(desc, ["short", "y" * 1200, "one paragraph that is long\n\nsecond"])
    assert got[0] == "Research publication: T"
    assert len(got[1]) == 1000 and got[1].endswith("...")
    assert got[2] == "one paragraph that is long"


def test_relevance_counts_distinct_words(one):
    p = K.DEFAULT_PROFILE
    got = one(lambda c: C.topical_relevance(p, F.lit("forum_post"), c),
              ["training domain explain", "AI ai", "AI safety", "doomed"])
    assert got == [0.25, 0.75, 1.0, 0.25]


def test_disagreement(spark):
    df = spark.createDataFrame([(0.5, 1.0, 300.0, None), (0.5, None, None, None)],
                               "s double, r double, k double, c double")
    a, b = [r[0] for r in df.select(C.signal_disagreement(
        F.col("s"), F.col("r"), F.col("k"), F.col("c"))).collect()]
    assert abs(a - 0.2357022603955158) < 1e-12 and b == 0.0


def test_shortlist_ties_go_to_the_first_category(spark):
    df = spark.createDataFrame([("Grant for the board",), ("nothing here",), ("He left today",)],
                               "t string")
    rows = C.with_shortlist_score(df, "t").select("category", "n_terms", "terms").collect()
    assert rows[0][:2] == ("funding_catastrophe", 2)
    assert rows[1][0] is None
    assert rows[2][0] == "organizational_crisis" and rows[2][2] == ["left"]


def test_evidence_dates(spark):
    cases = [("2019-11-04", "day", "on 4 November 2019", None),
             ("2019-11-04", "day", "November 4th, 2019", None),
             ("2019-11", "month", "dated 2019-11", None), ("2019", "year", "in 2019.", None),
             ("2019-11-04", "day", "in November 2019", "day"),
             ("2019-11", "month", "in 2019", "month"), ("2019", "year", "12019", "year"),
             ("2019", "year", "", "quote"), ("2019", "month", "2019", "month")]
    df = spark.createDataFrame([c[:3] for c in cases], "d string, p string, q string")
    got = [r[0] for r in df.select(E.missing_date_part(F.col("d"), F.col("p"), F.col("q"))).collect()]
    assert got == [c[3] for c in cases]


def test_grants(one):
    assert one(G.recipient_type, ["Deep Institute", "Ada Byron", "Ada", "R2 D2", "", None]) == [
        "organization", "individual", "organization", "organization", "unknown", "unknown"]


def test_signals_drop_missing_and_read_as_of(spark):
    df = spark.range(1).select(
        C.signals_map(F.lit("2026"), a=F.lit(1.0), b=F.lit(None).cast("double")).alias("s"),
        F.create_map(F.lit("k"), F.array(
            F.struct(F.lit("2025").alias("observed_at"), F.lit(1.0).alias("value")),
            F.struct(F.lit("2026").alias("observed_at"), F.lit(2.0).alias("value")))).alias("t"))
    row = df.select("s", C.latest(F.col("t"), "k"), C.value_as_of(F.col("t"), "k", F.lit("2025-06")),
                    C.latest(F.col("t"), "none")).first()
    assert set(row[0]) == {"a"} and row[1:] == (2.0, 1.0, None)
