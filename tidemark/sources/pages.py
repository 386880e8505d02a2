"""Profile pages and vCards: label-value tables to structs.

HTML is read with the standard library's parser, in Arrow batches.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import phone, trimmed

PROFILE = (
    "fields map<string,string>, display_name string, first_name string, last_name string, title string, membership_type string, membership_begins string, primary_email string, "
    "secondary_email string, phones array<struct<label:string,value:string,subtype:string>>, addresses array<struct<address_type:string,raw:string>>, "
    "household array<struct<name:string,relationship:string>>, boats array<struct<name:string,boat_type:string>>"
)
COLUMNS = [c.split()[0] for c in PROFILE.replace("map<string,string>", "map").split(", ")]
# Patterns of address labels, best first, and words of family relations.
ADDRESS_LABELS = [("summer_physical", r"summer.*(physical|street)"), ("summer_mailing", r"summer.*mail"), ("winter_physical", r"winter.*(physical|street)"), ("winter_mailing", r"winter.*mail"), ("year_round", r"year.?round"), ("mailing", r"^mailing"), ("physical", r"^physical|^street")]
RELATIONS = r"\b(spouse|wife|husband|partner|child|son|daughter|dependent|guest)\b"
HOUSEHOLD = r"household|family|other members|additional members"


class _Tables(HTMLParser):
    """Rows of all tables; a cell is the list of its texts between line breaks. Headings outside tables precede the next row."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, list[list[str]]]] = []
        self.open: list[list[list[str]]] = []
        self.cell: list[list[str]] | None = None
        self.heading = ""

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "tr":
            self.open.append([])
        elif tag in ("td", "th") and self.open:
            self.cell = [[]]
            self.open[-1].append(self.cell)
        elif tag == "br" and self.cell is not None:
            self.cell.append([])

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.cell = None
        elif tag == "tr" and self.open:
            cells = [[" ".join(" ".join(part).split()) for part in cell] for cell in self.open.pop()]
            self.rows.append((self.heading, [[p for p in cell if p] for cell in cells]))
        elif tag == "table":
            self.heading = ""

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell[-1].append(data)
        elif data.strip():
            self.heading = " ".join(data.split())


def _member(text: str) -> dict | None:
    dash = re.split(r"\s+[-–—]\s+", text, maxsplit=1)
    found = re.search(RELATIONS, dash[1] if len(dash) > 1 else text, re.I)
    name = dash[0].strip() if len(dash) > 1 else re.sub(r"\s*\([^)]*\)\s*", "", text).strip()
    return {"name": name, "relationship": found[1].lower() if found else "member"} if name else None


def read_profile(html: str | None) -> dict:
    """Label-value fields and what is known of identity, membership, contacts, addresses, household and boats."""
    tables = _Tables()
    tables.feed(html or "")
    fields: dict[str, str] = {}
    household: list[dict] = []
    listed: list[dict] = []
    boats: list[dict] = []
    for heading, cells in tables.rows:
        flat = [" ".join(c) for c in cells]
        if re.search(HOUSEHOLD, heading, re.I) and flat and flat[0]:
            relation = re.search(RELATIONS, " ".join(flat), re.I)
            listed.append({"name": flat[0], "relationship": relation[1].lower() if relation else "member"})
        elif re.search(r"\bboat|vessel|yacht", heading, re.I) and flat and flat[0]:
            boats.append({"name": flat[0], "boat_type": flat[1] if len(flat) > 1 and flat[1] else None})
        if len(flat) > 1 and (label := flat[0].strip().rstrip(":").strip()):
            if re.search(HOUSEHOLD, label, re.I) and len(label) < 60:
                household += [m for cell in cells[1:] for line in cell for part in line.split(",") if (m := _member(part.strip()))]
            if values := [v for v in flat[1:] if v]:
                fields[label] = values[-1]
    get = lambda *names: next((fields[n] for n in names if fields.get(n)), None)
    phones, addresses = [], []
    for label, value in fields.items():
        low = label.lower()
        if "phone" in low or "fax" in low:
            kinds = (("mobile", ("cell", "mobile")), ("fax", ("fax",)), ("home", ("home",)), ("work", ("work", "business")))
            phones.append({"label": label, "value": value, "subtype": next((k for k, words in kinds if any(w in low for w in words)), "other")})
    for kind, pattern in ADDRESS_LABELS:
        if hit := next((v for k, v in fields.items() if re.search(pattern, k, re.I)), None):
            addresses.append({"address_type": kind, "raw": hit})
    if not addresses and (hit := next((v for k, v in fields.items() if "address" in k.lower() and "mail" not in k.lower().replace("mailing", "")), None)):
        addresses.append({"address_type": "mailing", "raw": hit})
    if name := get("Boat Name", "Yacht Name", "Vessel Name"):
        boats = [{"name": name, "boat_type": get("Boat Type", "Yacht Type", "Vessel Type", "Class")}]
    return {
        "fields": fields, "display_name": get("Name", "Display Name", "Member Name"), "first_name": get("First Name"), "last_name": get("Last Name"), "title": get("Title"),
        "membership_type": get("Membership Type", "Member Type"), "membership_begins": get("Membership Begins", "Member Since"), "primary_email": get("Email", "Primary Email", "E-mail"),
        "secondary_email": get("Secondary Email", "Alternate Email"), "phones": phones, "addresses": addresses, "household": household or listed, "boats": boats,
    }


def profile(html: Column) -> Column:
    """Struct of a profile page; null and broken pages give empty parts."""

    def read(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_profile(h) for h in pages], columns=COLUMNS)

    return F.pandas_udf(read, PROFILE)(html)


def _unfolded(card: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(card, F.lit("")), r"\r?\n[ \t]", ""), r"\r?\n")


def vcard(card: Column) -> Column:
    """Struct of a vCard 3.0, natively: names, e-mails, phones and addresses with their types, and notes.

    Text without BEGIN:VCARD gives empty parts.
    """
    ok = F.upper(F.coalesce(card, F.lit(""))).contains("BEGIN:VCARD")
    rows = F.filter(_unfolded(card), lambda x: ok & x.contains(":") & ~F.upper(x).isin("BEGIN:VCARD", "END:VCARD"))
    cut = F.transform(
        rows,
        lambda x: F.struct(
            F.upper(F.regexp_extract(x, r"^([^;:]*)", 1)).alias("prop"),
            F.lower(F.coalesce(F.nullif(F.regexp_extract(x, r"(?i)^[^:]*;TYPE=([^;:]*)", 1), F.lit("")), F.lit("other"))).alias("type"),
            F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )

    def last(prop: str) -> Column:
        return F.try_element_at(F.transform(F.filter(cut, lambda r: r["prop"] == prop), lambda r: r["value"]), F.lit(-1))

    name = F.split(last("N"), ";")
    part = lambda i: trimmed(F.get(name, F.lit(i)))
    piece = lambda v, i: trimmed(F.get(F.split(v, ";"), F.lit(i)))
    address = lambda r: F.struct(
        r["type"].alias("address_type"), F.coalesce(piece(r["value"], 2), piece(r["value"], 1), piece(r["value"], 0)).alias("line1"), piece(r["value"], 3).alias("city"), piece(r["value"], 4).alias("state"),
        piece(r["value"], 5).alias("postal_code"), piece(r["value"], 6).alias("country"), F.regexp_replace(F.replace(r["value"], F.lit(";"), F.lit(", ")), r"^[, ]+|[, ]+$", "").alias("raw"),
    )
    return F.struct(
        last("FN").alias("full_name"), part(0).alias("last_name"), part(1).alias("first_name"), part(2).alias("middle_name"), part(3).alias("prefix"), part(4).alias("suffix"),
        F.transform(F.filter(cut, lambda r: r["prop"] == "EMAIL"), lambda r: r["value"]).alias("emails"),
        F.transform(F.filter(cut, lambda r: r["prop"] == "TEL"), lambda r: F.struct(r["value"].alias("value"), r["type"].alias("type"))).alias("phones"),
        F.filter(F.transform(F.filter(cut, lambda r: r["prop"] == "ADR"), address), lambda a: a["raw"] != "").alias("addresses"),
        last("ORG").alias("org"), last("TITLE").alias("title"), last("NOTE").alias("note"), last("BDAY").alias("birthday"),
    )


def merged_profile(df: DataFrame) -> DataFrame:
    """Profile ``p`` and vCard ``v`` of a row as one: the page wins, the card fills gaps; e-mails and phones once each."""
    mails = F.array_distinct(F.concat(F.array_compact(F.array("p.primary_email", "p.secondary_email")), F.coalesce("v.emails", F.array().cast("array<string>"))))
    norm = lambda x: F.struct(F.coalesce(phone(x["value"]), x["value"]).alias("key"), x["value"].alias("value"), x["subtype"].alias("subtype"))
    own = F.transform(F.col("p.phones"), norm)
    card = F.transform(F.transform(F.col("v.phones"), lambda x: F.struct(x["value"].alias("value"), x["type"].alias("subtype"))), norm)
    every = F.concat(own, card)
    kept = F.filter(every, lambda x, i: ~F.exists(F.slice(every, F.lit(1), i), lambda y: y["key"] == x["key"]))
    raws = F.transform(F.col("p.addresses"), lambda a: a["raw"])
    extra = F.filter(F.transform(F.col("v.addresses"), lambda a: F.struct(a["address_type"].alias("address_type"), a["raw"].alias("raw"))), lambda a: ~F.array_contains(raws, a["raw"]))
    return df.withColumns(
        {
            "display_name": F.coalesce("p.display_name", "v.full_name"), "first_name": F.coalesce("p.first_name", "v.first_name"), "last_name": F.coalesce("p.last_name", "v.last_name"),
            "title": F.coalesce("p.title", "v.prefix", "v.title"), "all_emails": mails, "all_phones": kept, "all_addresses": F.concat("p.addresses", extra),
        }
    )


def unvisited(discovered: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed crawl still has to fetch."""
    return discovered.dropDuplicates([key]).join(done.select(key), key, "left_anti")
