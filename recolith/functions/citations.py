"""Legal citations in texts: heads by one pattern, the lists behind them as tokens that a fold reads with the section before in hand.

A citation is a title (a code, a volume of federal law, a law or order with its number) and a list of sections: joined by commas, semicolons and ``and``; of ranges the two ends count,
and ``(b)`` alone stands for the section before it. Everything is an expression: titles and what follows them come from one ``regexp_extract_all``, whose lookahead
leaves what follows for the next title to be found in; a list's items from another, folded by ``aggregate``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, stable_key
from .values import cite

# Record fields whose text is read, upper-case with underscores.
FIELDS = ("LEGAL_BASIS", "LEGAL_AUTHORITY", "STATUTE", "LEGAL_CITATION", "LEGAL_REFERENCE", "AUTHORIZING_ORDER_LAW", "ENACTMENT", "CITATION", "LAW")

# Pages of sections, laws and orders.
SECTION_PAGES = "https://code.dccouncil.gov/us/dc/council/code/sections/"
LAW_PAGES = "https://code.dccouncil.gov/us/dc/council/laws/"
ORDER_PAGES = "https://dcregs.dc.gov/Common/MayorOrders.aspx?Type=MayorOrder&OrderNumber="


def spelt(*words: str) -> str:
    """Words with blanks between that may be missing, points behind single letters too."""
    return r"\s*".join(w + r"\.?" if len(w) == 1 else w.replace(" ", r"\s+") for w in words)


#: Titles: of the district's codes, its laws and acts with their number, mayors' orders, and the two federal codes with the number of a title in front.
DISTRICT = spelt("D", "C")
CODE = spelt(DISTRICT, "(?:Code|Official Code|Municipal Regulations)")
LAW = rf"{DISTRICT}\s*(Law|Act)\s+(\d+-\d+)"
ORDER = r"Mayor['’]?s\s+Order\s+(\d{4}-\d{1,4})"
STATUTES = rf"\b(\d+)\s*U\.?\s?S\.?\s*(?:C\.?|Code)(?![a-z])"
RULES = r"\b(\d+)\s*CFR\b"
_bare = lambda pattern: re.sub(r"\((?![?])", "(?:", pattern)
TITLE = "|".join(map(_bare, (CODE, LAW, ORDER, STATUTES, RULES)))
#: What may stand between a title and its list, and the parts of a list.
SIGN = r"\s*(?:§{1,2}|Sections?\b)?\s*"
SECTION = r"[0-9](?:[0-9A-Za-z]|[.\-](?=[0-9A-Za-z]))*+(?:\([^)]+\))*+"
BETWEEN = r"(?:\s*[–—]\s*|\s-\s|\s(?:to|through)\s)"
ITEM = rf"(?:{SECTION}(?:{BETWEEN}{SECTION})?|\([^)]+\))"
JOINT = r"\s*(?:[,;]\s*(?:and\s)?|and\s)(?:§{1,2}\s*)?"
LIST = rf"{ITEM}(?:{JOINT}(?!{TITLE}){ITEM})*+"
CITED = rf"(?i)(?:{TITLE})(?=({SIGN}(?:{LIST})?))"
#: Ranges without blanks: two sections of one title of a code; two numbers of a federal one.
SAME_TITLE = r"^((\d+)-[0-9][0-9A-Za-z.]*(?:\([^)]+\))*)-(\2-[0-9][0-9A-Za-z.]*(?:\([^)]+\))*)$"
NUMBERS = r"^(\d+(?:\.\d+)*(?:\([^)]+\))*)-(\d+(?:\.\d+)*(?:\([^)]+\))*)$"


def _ends(item: Column, code: Column, closed: Column) -> Column:
    """The ends of an item: range (two), from, to; ``closed``: ranges without blanks are single sections."""
    part = lambda pattern, i: F.regexp_extract(item, pattern, i)
    spaced = rf"(?i)^({SECTION}){BETWEEN}({SECTION})$"
    first = F.when(closed, "").when(code, part(SAME_TITLE, 1)).otherwise(part(NUMBERS, 1))
    second = F.when(code, part(SAME_TITLE, 3)).otherwise(part(NUMBERS, 2))
    return F.struct(item.alias("item"), part(spaced, 1).alias("from"), part(spaced, 2).alias("to"), first.alias("first"), second.alias("second"))


def _fold(items: Column) -> Column:
    """Sections of a list of ``_ends``. The state: the section that a bare ``(b)`` adds to, what has been found, and whether the list has broken off."""
    nothing = F.array().cast("array<string>")

    def step(s: Column, x: Column) -> Column:
        short = F.startswith(x["item"], F.lit("("))
        title = F.regexp_extract(x["from"], r"^(\d+)-", 1)
        until = F.when(F.contains(x["to"], F.lit("-")) | (title == ""), x["to"]).otherwise(F.concat(title, F.lit("-"), x["to"]))
        found = F.when(short, F.array(F.concat(s["base"], x["item"]))).when(x["from"] != "", F.array(x["from"], until)).when(x["first"] != "", F.array(x["first"], x["second"])).otherwise(F.array(x["item"]))
        single = F.regexp_replace(F.when(x["first"] != "", x["second"]).otherwise(x["item"]), r"\([^)]+\)$", "")
        base = F.when(short, s["base"]).when(x["from"] != "", until).otherwise(single)
        stop = s["stop"] | (short & (s["base"] == ""))
        return F.struct(F.when(stop, s["base"]).otherwise(base).alias("base"), F.when(stop, s["found"]).otherwise(F.concat(s["found"], found)).alias("found"), stop.alias("stop"))

    start = F.struct(F.lit("").alias("base"), nothing.alias("found"), F.lit(False).alias("stop"))
    return F.aggregate(items, start, step, lambda s: s["found"])


def _of_title(title: Column, rest: Column) -> Column:
    """Locators of one citation: its title and what follows."""
    part = lambda pattern, i: F.regexp_extract(title, "(?i)^" + pattern, i)
    law, order, statutes, rules = part(LAW, 2), part(ORDER, 1), part(STATUTES, 1), part(RULES, 1)
    sign = F.regexp_extract(rest, r"(?i)^\s*(§{1,2}|Sections?\b)?\s*", 1)
    closed, glued = sign == "§", rest.rlike(r"^\s*§(?![§\s])")
    code = (statutes == "") & (rules == "")
    name = F.when(statutes != "", F.concat(statutes, F.lit(" U.S.C. § "))).when(rules != "", F.concat(rules, F.when(glued, " CFR §").when(closed, " CFR § ").otherwise(" CFR "))).otherwise(F.concat(title, F.lit(" § ")))
    listed = F.regexp_extract_all(F.regexp_replace(rest, "(?i)^" + SIGN, ""), F.lit(f"(?i){ITEM}"), F.lit(0))
    sections = F.transform(_fold(F.transform(listed, lambda x: _ends(x, code, closed))), lambda x: F.concat(name, x))
    return F.when(law != "", F.array(F.concat(F.lit("D.C. "), F.initcap(part(LAW, 1)), F.lit(" "), law))).when(order != "", F.array(F.concat(F.lit("Mayor's Order "), order))).otherwise(sections)


def locators_of(text: Column) -> Column:
    """Locators of a text: distinct, sorted; empty for null. Titles of codes keep their spelling, and so does a federal citation with one sign."""
    clean = F.regexp_replace(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), "(?<=[0-9])[–—](?=[0-9])", "-")
    both = lambda t: F.arrays_zip(F.regexp_extract_all(t, F.lit(CITED), F.lit(0)).alias("title"), F.regexp_extract_all(t, F.lit(CITED), F.lit(1)).alias("rest"))
    every = F.flatten(F.transform(let(clean, both), lambda c: _of_title(c["title"], c["rest"])))
    return F.when(text.rlike(rf"(?i){TITLE}"), F.array_sort(F.array_distinct(every))).otherwise(F.array().cast("array<string>"))


#: A locator that is a section of the code.
_CODE_SECTION = r"^D\.?\s*C\.? (?:Official )?Code § ([0-9][0-9A-Za-z.\-]*(?:\([^)]+\))*)$"


def payload_text(payload: Column) -> Column:
    """The texts of a record's legal fields, apart by line ends; the field's name in any case, with blanks for underscores."""
    fields = F.map_entries(F.from_json(payload, "map<string,string>"))
    legal = F.filter(fields, lambda e: F.upper(F.regexp_replace(F.trim(e["key"]), r"\s+", "_")).isin(*FIELDS))
    return F.array_join(F.transform(legal, lambda e: e["value"]), " | ")


def payload_locators(payload: Column) -> Column:
    """``locators_of`` a record's legal fields. A text without backslashes stands in its payload as it is, so a payload without a title in it isn't read."""
    may = F.contains(payload, F.lit("\\")) | payload.rlike(rf"(?i){TITLE}")
    return F.when(may, locators_of(payload_text(payload))).otherwise(F.array().cast("array<string>"))


def url_locators(url: Column) -> Column:
    """Of pages of the code: its section or law."""
    on_site = url.rlike(r"(?i)^https?://code\.dccouncil\.(?:gov|us)/")
    section = F.regexp_replace(F.regexp_extract(url, r"(?i)/code/sections/([^/?#]+)", 1), r"(?i)\.html$", "")
    law = F.regexp_extract(url, r"(?i)/laws/(\d+-\d+)", 1)
    found = F.when(section != "", F.array(F.concat(F.lit("D.C. Code § "), F.coalesce(F.try_url_decode(section), section)))).when(law != "", F.array(F.concat(F.lit("D.C. Law "), law)))
    return F.when(F.coalesce(on_site, F.lit(False)) & found.isNotNull(), found).otherwise(F.array().cast("array<string>"))


def record_citations(source: Column, record: Column, found: Column) -> Column:
    """The record's own citation and one with each locator."""
    return F.concat(F.array(cite(source, record)), F.transform(F.array_distinct(found), lambda x: cite(source, record, x)))


def authority(locator: Column) -> Column:
    """authority_type, locator, id, canonical_url of locators that are authorities; null for others. Titles of the code go from 1 to 99."""
    part = lambda pattern: F.regexp_extract(locator, pattern, 1)
    parts = F.struct(part(_CODE_SECTION).alias("section"), part(r"^D\.C\. Law (\d+-\d+)$").alias("law"), part(r"^Mayor's Order (\d{4}-\d{1,4})$").alias("order"))
    return let(parts, _authority_of)


def _authority_of(parts: Column) -> Column:
    section, law, order = parts["section"], parts["law"], parts["order"]
    title = F.regexp_extract(section, r"^(\d+)-", 1).try_cast("int")

    def made(kind: str, text: Column, url: Column) -> Column:
        return F.struct(F.lit(kind).alias("authority_type"), text.alias("locator"), F.concat(F.lit("legal_authority:"), stable_key(text)).alias("id"), url.alias("canonical_url"))

    root = F.regexp_replace(section, r"(?:\([^)]+\))+$", "")
    return (
        F.when(title.between(1, 99), made("dc_code", F.concat(F.lit("D.C. Code § "), section), F.concat(F.lit(SECTION_PAGES), root)))
        .when(law != "", made("dc_law", F.concat(F.lit("D.C. Law "), law), F.concat(F.lit(LAW_PAGES), law)))
        .when(order != "", made("mayors_order", F.concat(F.lit("Mayor's Order "), order), F.concat(F.lit(ORDER_PAGES), order)))
    )


def is_section(locator: Column) -> Column:
    return locator.rlike(_CODE_SECTION)


def is_rejected(locator: Column) -> Column:
    """Looks like a section of the code but is none."""
    return is_section(locator) & authority(locator).isNull()
