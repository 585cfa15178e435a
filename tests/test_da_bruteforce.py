"""Second-publisher extraction (P6, F13, W6, X13, X18) on generated alerts whose rows are known beforehand.

Nothing here parses HTML: alerts are written from random listings, and what
the extraction must return follows from how each alert was put together.
"""

import random
from collections import defaultdict

import pytest

from bidlake.operators import extract, html
from tests.fixtures import SECOND, SECOND_HTML, SECOND_SUBJECT, Listing, label_table, listing_rows, second_alert

FIELDS = ["opportunityTitle", "url", "donorClient", "countryRegion", "deadline", "deadlineISO", "opportunityType", "status"]
LABELS = {"donor": ["Funding agency:", "Donor", "CLIENT :"], "country": ["Location:", "Countries", "Region::"], "deadline": ["Deadline:", "Closing", "Cierre :"]}


def extracted(spark, alerts):
    docs = spark.createDataFrame([(name, SECOND_SUBJECT, body) for name, body in alerts], "doc_id string, subject string, html string")
    nodes, strings = html.dom_facts(docs, materialize=False)
    found = defaultdict(list)
    for r in extract.da_listings(nodes, strings, docs, "2026-07-16", 15).orderBy("doc_id", "link_pos").collect():
        found[r["doc_id"]].append(tuple(r[c] for c in FIELDS))
    return found


def row(x, kind="Tender", status=""):
    return (x.title, x.url, x.donor, x.country, x.deadline, x.iso, kind, status)


def random_listing(pick, n):
    words = ["supply", "of", "laboratory", "fieldwork", "bridges", "audit", "training", "harvest", "survey", "clinics"]
    day, month = pick.randrange(1, 29), pick.randrange(1, 13)
    name = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"][month - 1]
    dated = pick.random() < 0.8
    return Listing(" ".join(pick.choice(words) for _ in range(5)) + f" lot {n}", f"https://developmentaid.org/{pick.choice(['tenders', 'grants', 'jobs'])}/view/{n}",
                   pick.choice(["", "Lake Fund", "Agency of Roads"]), pick.choice(["", "Nepal", "Chad, Niger"]),
                   f"{day:02d} {name}, 2027" if dated else "", f"2027-{month:02d}-{day:02d}" if dated else "")


@pytest.mark.parametrize("seed", range(3))
def test_generated_alerts(spark, seed):
    pick, alerts, want, n = random.Random(seed), [], {}, 0
    for a in range(12):
        listings = []
        for _ in range(pick.randrange(1, 5)):
            n += 1
            listings.append(random_listing(pick, n))
        body, seen = "", []
        for x in listings:
            body += listing_rows(x, [pick.choice(LABELS[k]) for k in ("donor", "country", "deadline")], badge=pick.choice(["new", "hot", ""]))
            if pick.random() < 0.3:  # the same listing again, with a tracking parameter
                body += listing_rows(Listing(x.title + " again", x.url + "?utm_source=mail"))
            if pick.random() < 0.3:  # too short, a label, or no listing
                body += f"<tr><td><a href='https://developmentaid.org/tenders/view/s{n}'>{pick.choice(['Read more', 'short one'])}</a></td></tr>"
                body += "<tr><td><a href='https://developmentaid.org/news/list'>News of the week from the desk</a></td></tr>"
            seen.append(x)
        kind, heading = pick.choice([("Tender", "Tender Alert"), ("Grant", "Grant alert"), ("Opportunity", "Weekly list")])
        outside = listing_rows(random_listing(pick, 5000 + a))
        scoped = pick.random() < 0.5
        name = f"s{seed}a{a}"
        if scoped:
            alerts.append((name, f"<body><h1>{heading}</h1><h3>Forecast</h3><table>{outside}</table><h3>Open</h3><table>{body}</table></body>"))
        else:
            alerts.append((name, f"<body><h1>{heading}</h1><table>{body}</table></body>"))
        want[name] = [row(x, kind) for x in seen]
    got = extracted(spark, alerts)
    for name, _ in alerts:
        assert got[name] == want[name], name


def test_the_fixture(spark):
    assert extracted(spark, [("f", SECOND_HTML)])["f"] == [row(x) for x in SECOND]


def test_section_without_listings_does_not_scope(spark):
    x = SECOND[0]
    body = second_alert([], outside=f"<table>{listing_rows(x)}</table>")
    assert extracted(spark, [("d", body)])["d"] == [row(x)]


def test_status_from_the_text_around_the_link(spark):
    x = SECOND[1]
    body = f"<body><div><p><a href='{x.url}'>{x.title}</a> is open to all</p></div></body>"
    assert extracted(spark, [("d", body)])["d"] == [(x.title, x.url, "", "", "", "", "Opportunity", "Open")]


def test_last_of_equal_labels_and_nested_cells(spark):
    x = SECOND[0]
    nested = label_table([("Donor:", "First"), ("Donor:", "Second"), ("Country", "Peru <table><tr><td>inner</td></tr></table>")])
    body = f"<body><table><tr><td><table><tr><td><a href='{x.url}'>{x.title}</a></td></tr></table></td></tr><tr><td>{nested}</td></tr></table></body>"
    (got,) = extracted(spark, [("d", body)])["d"]
    assert got[2] == "Second" and got[3].startswith("Peru")
