"""Column functions against value tables and properties."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bidlake.functions import dates as D
from bidlake.functions import normalize as N
from bidlake.functions import text as T
from bidlake.functions import urls as U


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr).first()[0]


def col_values(spark, expr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


# Pieces of text and their normal forms (a separated accent leaves a gap), worked out by hand.
PIECES = {"Harbour": "harbour", "Año": "an o", "①½": "11 2", "(Lot-4)": "lot 4", "snake_case": "snake_case", "CAFÉ": "cafe", "ﬁnal": "final", "–": "", "...": "", "Ж9": "ж9", "\u00a0": "", "\t\n": ""}


def test_normalize_values(spark):
    assert col_values(spark, N.normalize_text("v"), [*PIECES, None, "", "  b\tC  "]) == [*PIECES.values(), "", "", "b c"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(sorted(PIECES)), max_size=8), min_size=1, max_size=20))
def test_normalize_joins_the_forms_of_its_pieces(spark, texts):
    got = col_values(spark, N.normalize_text("v"), [" ".join(t) for t in texts])
    assert got == [" ".join(PIECES[p] for p in t if PIECES[p]) for t in texts]


def test_normalize_properties_on_documents(spark):
    from tests.conftest import SF01

    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("text", N.normalize_text("text").alias("n"))
    rows = docs.select("text", "n", N.normalize_text("n").alias("again"), N.normalize_text(F.concat(F.lit(" ¡"), F.col("text"), F.lit("?! "))).alias("framed")).collect()
    for r in rows:
        assert r["again"] == r["n"] == r["framed"] and r["n"] == r["n"].lower()
        assert "  " not in r["n"] and r["n"].strip() == r["n"] and all(c == " " or c == "_" or c.isalnum() for c in r["n"])
        ascii_words = [w.lower() for w in r["text"].split() if w.isascii() and w.isalnum()]
        assert set(ascii_words) <= set(r["n"].split(" "))


def test_duplicate_key(spark):
    df = spark.createDataFrame([("Devex", "  Bridge  Repair ", "Road Fund", "Laos", ""),
                                ("Devex", "Bridge Repair", "Road Fund", "Laos", None),
                                ("DevelopmentAid", "Œuvre n° 5: Ça\x1fva", None, " ", "https://x/y"),
                                ("Devex", "X", "Y", "Z", "https://x/y?report=abc-1&z=2")],
                               "s string, t string, d string, c string, u string")
    keys = [r[0] for r in df.select(N.duplicate_key("s", "t", "d", "c", "u")).collect()]
    assert keys[0] == keys[1] == "devex | bridge repair | road fund | laos"
    assert keys[2] == "developmentaid | œuvre n 5 c a va |  | "
    assert keys[3] == "devex | devex-report:abc-1"


def test_language(spark):
    vals = ["Servicios de laboratorio para hospitales", "Bridge Repair in Two Provinces",
            "Seed Storage, Handling and Transport (SEEDS) for Hill Farms", "", None, "laéde x",
            "ASISTENCIA TÉCNICA rural"]
    assert col_values(spark, N.infer_language("v"), vals) == [
        "Spanish", "English", "English", "", "", "English", "Spanish"]


def test_text_helpers(spark):
    assert col_values(spark, T.normalize_date("v"), ["2026-07-16T10:00:00Z", None, "2026"]) == [
        "2026-07-16", "", "2026"]
    assert col_values(spark, T.opp_url("v"), ["abc", "", None]) == ["https://sam.gov/opp/abc/view", "", ""]
    assert col_values(spark, T.agency_label("v"), ["097", "", None]) == ["097", "ALL", "ALL"]
    assert col_values(spark, T.trim_ws("v"), ["　 a b \n", "x"]) == ["a b", "x"]
    assert col_values(spark, T.label_key("v"), [" Funding agency: ", "Deadline::", ":"]) == [
        "funding agency", "deadline", ""]
    assert one(spark, T.mmddyyyy(F.to_date(F.lit("2026-07-09"))), None) == "07/09/2026"
    assert col_values(spark, T.opportunity_type("v"), ["<h2>Tender Alert</h2>", "GRANT ALERT", "x"]) == [
        "Tender", "Grant", "Opportunity"]


def test_fallback_date(spark):
    vals = ["2024-03-05", "2024-3-5 extra", "2024-3-5", "bad", "", None]
    got = col_values(spark, F.date_format(T.iso_date_or_fallback("v", "2026-07-16"), "yyyy-MM-dd"), vals)
    assert got == ["2024-03-05", "2025-07-16", "2024-03-05", "2025-07-16", "2025-07-16", "2025-07-16"]


def test_urls(spark):
    assert col_values(spark, U.clean_url("v"), [
        "https://h/p?utm_a=1&id=5", "https://h/p?id=5&ref=x", "https://h/p?source=a", "https://h/p"]) == [
        "https://h/p&id=5", "https://h/p?id=5", "https://h/p", "https://h/p"]
    enc = "https://track.pstmrk.it/3s/https%3A%2F%2Fwww.devex.com%2Ffunding%2Fr%3Freport%3D77?x=1"
    assert col_values(spark, U.decode_tracking_url("v"), [enc, "https://a/b", "https://track.pstmrk.it/3s/a+b%2B"]) == [
        "https://www.devex.com/funding/r?report=77", "https://a/b", "a+b+"]
    assert col_values(spark, U.devex_skip("v"), [
        "https://www.devex.com/home", "https://www.devex.com/funding/r?report=1", "mailto:x", "x#y"]) == [
        True, False, True, True]
    assert col_values(spark, U.da_listing("v"), [
        "https://developmentaid.org/tenders/view/1", "https://developmentaid.org/login"]) == [True, False]
    assert col_values(spark, U.da_skip("v"), ["https://developmentaid.org/", "https://developmentaid.org/news/1"]) == [
        True, True]


def test_deadlines(spark):
    vals = ["October 7, 2026", "04 Nov, 2026", "28 Feb, 2027", "May 2, 2027", "1/9/2026", "2026-09-01", "2026-09-21",
            "", None, "no date here", "Sept 3rd 2026"]
    got = col_values(spark, D.deadline_iso("v", "2026-07-16"), vals)
    assert got == ["2026-10-07", "2026-11-04", "2027-02-28", "2027-05-02", "2026-09-01", "2026-01-09", "2026-09-21",
                   "", "", "", "2026-09-03"]
    assert col_values(spark, D.deadline_fallback(F.lit("2026-01-02"), "v", "2026-07-16"), ["x"]) == ["2026-01-02"]


def test_free_form_dates_against_a_general_parser(spark):
    """Free forms of known dates; the general parser reads each the same way, day first and with the run date's parts."""
    import random
    from datetime import datetime

    from dateutil import parser

    pick, run = random.Random(12), datetime(2026, 7, 16)
    month = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
    day = ["Mon", "Tuesday", "Wed", "Thursday", "Fri", "Saturday", "Sun"]
    texts = []
    for _ in range(400):
        d, m, y = pick.randrange(1, 32), pick.randrange(1, 13), pick.randrange(1980, 2070)
        name = pick.choice([month[m - 1], month[m - 1][:3], month[m - 1].upper()])
        texts.append(pick.choice([f"{d} {name} {y}", f"{name} {d}, {y}", f"{d}{pick.choice(['st', 'nd', 'rd', 'th'])} of {name} {y}", f"{name} {d}th, {y} 17:30", f"{d}-{name}-{y}",
                                  f"{pick.choice(day)}, {d} {name} {y}", f"{d}/{m}/{y}", f"{m:02d}/{d:02d}/{y}", f"{d}.{m}.{y}", f"{y}-{m:02d}-{d:02d}", f"{y}/{m}/{d}", f"{y}{m:02d}{d:02d}",
                                  f"{name} {y}", f"{d} {name}", f"{d}/{m}", f"{d} {name} {y} at 5pm", f"{d}/{m}/{y % 100:02d}", f"{d} {name} {y % 100:02d}"]))
    texts += ["tomorrow", "no date here", "31 February 2027", "5 March 2027 or so", "(5 March 2027)", "May", "  4 May 2027 "]

    def general(text):
        try:
            return parser.parse(text, dayfirst=True, default=run).date().isoformat()
        except (ValueError, OverflowError):
            return ""

    got = dict(zip(texts, col_values(spark, D.deadline_iso("v", "2026-07-16"), texts)))
    differ = {t: (got[t], general(t)) for t in texts if got[t] != general(t)}
    assert not differ, sorted(differ.items())


def test_mail_date_and_base64(spark):
    assert col_values(spark, D.mail_date("v"), ["Thu, 16 Jul 2026 23:30:00 -0500", "junk", None]) == [
        "2026-07-16", "", ""]
    import base64

    raw = "Año – ok ✓".encode()
    b = base64.urlsafe_b64encode(raw).decode().rstrip("=")
    assert col_values(spark, D.base64url_text("v"), [b]) == [raw.decode()]


_PARAMETERS = st.lists(st.sampled_from(["id=5", "page=2", "q=a%2Fb", "xref=1", "utm_source=mail", "utm_x=1", "ref=feed", "source=a.b"]), max_size=6)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_PARAMETERS, min_size=1, max_size=15))
def test_clean_url_keeps_other_parameters_with_their_signs(spark, lists):
    signed = [[("?" if i == 0 else "&") + p for i, p in enumerate(ps)] for ps in lists]
    want = ["https://h/p" + "".join(x for x in ps if not x[1:].startswith(("utm_", "ref=", "source="))) for ps in signed]
    assert col_values(spark, U.clean_url("v"), ["https://h/p" + "".join(ps) + "?&&"[:2 * (i % 2)] for i, ps in enumerate(signed)]) == want


def test_first_present(spark):
    keys = ("funding agency", "donor", "client")
    maps = [({"client": "c", "donor": "d"}, "d"), ({"client": "c", "funding agency": "", "donor": "d"}, ""), ({"x": "y"}, ""), ({}, ""), ({"client": "é" * 130}, "é" * 100)]
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(maps)], "i int, m map<string,string>")
    assert [r[0] for r in df.orderBy("i").select(T.first_present("m", keys)).collect()] == [w for _, w in maps]
