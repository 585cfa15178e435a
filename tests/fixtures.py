"""Alert mails written from listings, so every test knows its answers by construction.

``first_alert`` and ``second_alert`` lay the given listings out the way each
publisher does (one-cell rows under a title row; a label table in the row after
a nested title table) and add links that are no listings.
"""

from dataclasses import dataclass


@dataclass(frozen=True)
class Listing:
    title: str
    url: str
    donor: str = ""
    country: str = ""
    deadline: str = ""
    iso: str = ""
    status: str = ""


RURAL_WATER = Listing("Rural Water Supply Design Services for the Upper Valley Districts", "https://www.devex.com/en/opportunity/rural-water-supply-9001",
                      "Nordic Green Fund", "Bhutan", "March 3, 2027", "2027-03-03", "OPEN")
COASTAL = Listing("Coastal Erosion Mapping and Training of Harbour Staff", "https://www.devex.com/en/opportunity/coastal-erosion-9002",
                  "Island Development Bank", "Samoa", "November 21, 2026", "2026-11-21", "CLOSED SOON")
FIRST = [RURAL_WATER, COASTAL]
FIRST_SUBJECT = "2 new reports for your Business Alert: Island Water"

SCHOOLS = Listing("Supervisión de obras escolares en la región andina del sur", "https://developmentaid.org/tenders/view/obras-escolares-7001",
                  "Fondo Andino", "Bolivia", "05 Dec, 2026", "2026-12-05")
VACCINES = Listing("Cold Chain Equipment for District Vaccine Stores (Lot 4)", "https://developmentaid.org/tenders/view/cold-chain-7002",
                   "Health Partners Trust", "Malawi", "19 Jan, 2027", "2027-01-19")
SECOND = [SCHOOLS, VACCINES]
SECOND_SUBJECT = "2 Funding opportunities from DevelopmentAid: Works and Goods"


def first_alert(listings, heading="Tenders &amp; Grants", quote='"'):
    rows = []
    for x in listings:
        rows.append(f"<tr><td><p><a href={quote}{x.url}{quote}>\n {x.title}\n</a></p></td><td><b>{x.status}</b></td></tr>")
        rows += [f"<tr><td>{value}</td></tr>" for value in (x.donor, x.country, x.deadline)]
        rows.append("<tr><td>&nbsp;</td></tr>")
    links = "".join(f"<li><a href='https://www.devex.com/{page}'>Our {page} page for members</a></li>" for page in ("home", "account/unsubscribe"))
    return f"<html><body><h1>{heading}</h1><table><tbody>{''.join(rows)}</tbody></table><ul>{links}<li><a href='https://linkedin.com/x'>Follow us on this network</a></li></ul></body></html>"


def label_table(pairs):
    return "<table>" + "".join(f"<tr><td>{k}</td><td>{v}</td></tr>" for k, v in pairs) + "</table>"


def listing_rows(x, labels=("Funding agency:", "Location:", "Deadline:"), badge="new"):
    title = f"<table><tr><td><a href='{x.url}'> {x.title} </a></td><td>{badge}</td></tr></table>"
    return f"<tr><td>{title}</td></tr><tr><td>{label_table(zip(labels, (x.donor, x.country, x.deadline)))}</td></tr>"


def second_alert(listings, heading="Tender Alert", section="Open", outside=""):
    body = "".join(listing_rows(x) for x in listings)
    return (f"<html><body><h2>{heading}: weekly list</h2>{outside}<h4>{section}</h4><table>{body}</table>"
            "<p><a href='https://developmentaid.org/login'>Sign in to your own account</a> <a href='mailto:desk@example.org'>Write to the desk</a></p></body></html>")


FIRST_HTML, SECOND_HTML = first_alert(FIRST), second_alert(SECOND)
