"""Text, URL, value and citation functions on single values."""

import random

import pytest
from pyspark.sql import functions as F

from recolith.functions import citations as ci
from recolith.functions import text as tx
from recolith.functions import url as ur
from recolith.functions import values as va


@pytest.fixture(scope="module")
def value(spark):
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]


def cases():
    # Inputs and the results that they must have.
    return [
        (tx.blank_to_null(F.lit(" \t a b\n")), "a b"),
        (tx.blank_to_null(F.lit("  ")), None),
        (tx.strip_tags(F.lit("<p>A&nbsp;&amp;lt; <b>b</b>\n c</p>")), "A &lt; b c"),
        (tx.strip_tags(F.lit("&sect; 1 &rsquo;"), tx.TYPOGRAPHIC_ENTITIES), "§ 1 ’"),
        (tx.first_paragraph(F.lit("<p> </p><pre>x</pre><p class='a'>Two <i>words</i></p><p>no</p>")), "Two words"),
        (tx.is_script_shell(F.lit("You must Enable JavaScript to go on")), True),
        (tx.lookup_key(F.lit(" Dept. of A&B ")), "department of a and b"),
        (tx.normalize_name(F.lit("Café & Co.")), "caf and co"),
        (tx.normalize_name(F.lit("...")), None),
        (tx.name_key(F.lit("A-b 1")), "ab1"),
        (tx.match_key(F.lit("<b>Office</b> of X-Y")), "office of x y"),
        (tx.stable_key(F.lit("--A b--")), "a-b"),
        (tx.review_key(F.lit("!!")), "item"),
        (tx.fnv1a_base36(F.lit("abc")), "7aigaz"),
        (tx.review_id_segment(F.lit("abc"), 2), "ab-7aigaz"),
        (tx.percent_id(F.lit("a~b/ü c'")), "a~7Eb~2F~C3~BC~20c'"),
        (tx.entity_slug(F.lit("Café d’Été & Co.")), "cafe-dete-and-co"),
        (tx.entity_slug(F.lit("日本")), "~E6~97~A5~E6~9C~AC"),
        (tx.candidate_names(F.lit("Office of Zoning (Board) - OZ")), ["Office of Zoning (Board) - OZ", "Office of Zoning (Board)", "Office of Zoning - OZ", "Office of Zoning"]),
        (tx.name_and_acronym(F.lit("Food Board (FPC)")), ("Food Board", "FPC")),
        (tx.name_and_acronym(F.lit("Food Board")), ("Food Board", None)),
        (tx.member_title(F.lit("Ward 3 Councilmember")), ("ward", "3")),
        (tx.member_title(F.lit("Chairman")), ("chair", None)),
        (tx.member_title(F.lit("At-Large Councilmember")), ("at_large", None)),
        (tx.strip_label(F.lit("smd 1A01"), "SMD", "ANC"), "1A01"),
        (tx.id_slug(F.lit("a.b:c:d")), "c:d"),
        (tx.raw_verb(F.lit("relation:governs")), "governs"),
        (tx.source_family(F.lit("gis.boards")), "gis"),
        (tx.scrub_contacts(F.lit("Write to a@b.org or c@d.org.  Call 555-1234 .")), "Write to or c@d.org. Call."),
        (tx.scrub_contacts(F.lit("We meet. For questions call 202-555-1234 today. The Board can be reached by phone: (202) 555-1234. All correspondence should be sent to us.")), "We meet."),
        (tx.scrub_contacts(F.lit("Rooms 12 and 1234567890123 stay, Fax: 555-1234.\nSo does a.b.")), "So does a.b."),
        (tx.scrub_contacts(F.lit(" ")), ""),
        (tx.scrub_contacts(F.lit("See " + "a" * 80 + "@b.org now.")), "See now."),
        (tx.scrub_contacts(F.lit("No cue,  here .\nAt all")), "No cue, here. At all"),
        (tx.replace_first(F.lit("a1b2"), "[0-9]", "-"), "a-b2"),
        (tx.without_email(F.lit("x" * 70 + "@y.org z")), " z"),
        (tx.percent_id(F.lit("(*!)_-. é~")), "(*!)_-.~20~C3~A9~7E"),
        (tx.clean_description(F.lit("The commission hears appeals from every ward of the city. Send an email if you can.")), None),
        (tx.clean_description(F.lit("Point of Contact: somebody who answers every letter there is.")), None),
        (tx.clean_description(F.lit("The board advises the council on food and farms in the city. Learn more about food.")), "The board advises the council on food and farms in the city."),
        (tx.clean_description(F.lit("Too short.")), None),
        (tx.clean_statute(F.lit(" N/A ")), None),
        (tx.clean_statute(F.lit("D.C. Code § 1-1")), "D.C. Code § 1-1"),
        (tx.is_recess_noise(F.lit("Council (RECESS)")), True),
        (tx.classify(F.lit("Council Committee on Boards"), tx.BODY_RULES, "public_body"), "committee"),
        (tx.classify(F.lit("Library"), tx.BODY_RULES, "public_body"), "public_body"),
        (ur.canonical_url(F.lit(" HTTPS://A.example:443/Path//?utm=1#x ")), "https://a.example/path"),
        (ur.canonical_url(F.lit("http://a.example:8080/")), "http://a.example:8080"),
        (ur.canonical_url(F.lit("no url")), ""),
        (ur.without_www(F.lit("https://www.a.example/b#c")), "https://a.example/b"),
        (ur.resolve(F.lit("https://a.example/x/y"), F.lit("../z")), "https://a.example/z"),
        (ur.is_detail_url(F.lit("https://a.example/public-bodies/food-board?x"), "public-bodies"), True),
        (ur.is_detail_url(F.lit("https://a.example/public-bodies"), "public-bodies"), False),
        (ur.detail_slug(F.lit("https://a.example/public-bodies/Food-Board")), "food-board"),
        (ur.names_local_file(F.lit("http://x/file%253A///C%3A/a")), True),
        (ur.names_local_file(F.lit("http://x/profile/a+b")), False),
        (ur.official_url(F.lit("https://a.example/x.PDF")), None),
        (ur.official_url(F.lit("mailto:a@b.c")), None),
        (ur.looks_like_url(F.lit(" HTTP://a")), True),
        (ur.is_url_key(F.lit("home_url")), True),
        (ur.is_url_key(F.lit("webUrl")), False),
        (va.stable_json(F.lit('{"b": [{"d": 1, "c": 2}], "a": null}')), '{"a":null,"b":[{"c":2,"d":1}]}'),
        (va.stable_json(F.lit("{")), None),
        (va.json_string(F.lit('{"a": " ", "b": 12, "c": "x"}'), "a", "b", "c"), "12"),
        (va.json_string(F.lit('{"a": true, "c": " x "}'), "a", "c"), "x"),
        (va.is_object(F.lit("[1]")), False),
        (va.unquoted(va.quoted(F.lit('a"b\\'))), 'a"b\\'),
        (va.unquoted(F.lit("12")), None),
        (va.attribute_text(F.lit('["a","b"]')), "a; b"),
        (va.attribute_text(F.lit("true")), "true"),
        (va.attribute_text(F.lit('{"a":1}')), None),
        (va.iso_timestamp(F.lit("Tue, 02 Jan 2024 03:04:05 GMT")), "2024-01-02T03:04:05.000Z"),
        (va.iso_timestamp(F.lit("yesterday")), None),
        (va.is_utc_iso(F.lit("2024-01-02T03:04:05.000Z")), True),
        (va.is_utc_iso(F.lit("2024-01-02T03:04:05Z")), False),
        (va.is_count(F.lit("007")), False),
        (va.collection_status(F.lit(1), F.lit(0)), "collected_empty"),
        (va.release_status(F.lit(True), F.lit(5), F.lit(1), F.lit(1)), "inventory_only"),
        (va.release_status(F.lit(False), F.lit(0), F.lit(1), F.lit(1)), "collected_not_exported"),
        (ci.url_locators(F.lit("https://code.dccouncil.us/dc/council/code/sections/50-1831.html")), ["D.C. Code § 50-1831"]),
        (ci.url_locators(F.lit("https://code.dccouncil.gov/us/dc/council/laws/24-176")), ["D.C. Law 24-176"]),
        (ci.url_locators(F.lit("https://example.org/laws/24-176")), []),
        (ci.is_rejected(F.lit("D.C. Code § 100-1")), True),
        (ci.is_rejected(F.lit("D.C. Code § 1-1")), False),
    ]


def test_values(spark):
    """All in one projection, as a query would hold them."""
    every = cases()
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(every)]).first()
    plain = lambda v: tuple(v) if hasattr(v, "asDict") else v
    wrong = [(i, every[i][1], plain(v)) for i, v in enumerate(row) if plain(v) != every[i][1]]
    assert not wrong


def test_authority(value):
    got = value(ci.authority(F.lit("D.C. Code § 2-101(a)(1)")))
    assert tuple(got) == ("dc_code", "D.C. Code § 2-101(a)(1)", "legal_authority:d-c-code-2-101-a-1", "https://code.dccouncil.gov/us/dc/council/code/sections/2-101")
    assert value(ci.authority(F.lit("Mayor's Order 2009-225")))["authority_type"] == "mayors_order" and value(ci.authority(F.lit("D.C. Code § 0-1"))) is None


def test_record_citations(spark):
    payload = '{"legal_basis":"D.C. Code § 2-501(a)","LEGAL reference":"5 CFR 1","note":"D.C. Code § 9-9"}'
    row = spark.createDataFrame([("s", "r", payload)], "s string, r string, p string").withColumn("found", ci.locators_of(ci.payload_text(F.col("p"))))
    got = row.select(ci.record_citations(F.col("s"), F.col("r"), F.col("found")).alias("c")).first()["c"]
    assert [c["locator"] for c in got] == [None, "5 CFR 1", "D.C. Code § 2-501(a)"]


LOCATORS = {
    "D.C. Code §§ 2-601 - 2-602 and 3-101 to 3-103; D.C. Municipal Regulations §§ 8-101, 8-102, and 8-103; D.C. Code §§ 2-1601 to 1608": "D.C. Code § 2-1601|D.C. Code § 2-1608|D.C. Code § 2-601|D.C. Code § 2-602|D.C. Code § 3-101|D.C. Code § 3-103|D.C. Municipal Regulations § 8-101|D.C. Municipal Regulations § 8-102|D.C. Municipal Regulations § 8-103",
    "42 U.S.C. §§ 1983, 1984 to 1986; 5 U.S.C. §§ 101(a), 101(b)": "42 U.S.C. § 1983|42 U.S.C. § 1984|42 U.S.C. § 1986|5 U.S.C. § 101(a)|5 U.S.C. § 101(b)",
    "12 CFR §§ 34.5, 34.6; 5 CFR §§ 1000 to 1002; 40 CFR §§ 100a-1, 100a-2": "12 CFR 34.5|12 CFR 34.6|40 CFR 100a-1|40 CFR 100a-2|5 CFR 1000|5 CFR 1002",
    "D.C. Code §§ 2-101(a)(1), (2), and 2-102(a)(i), (ii)": "D.C. Code § 2-101(a)(1)|D.C. Code § 2-101(a)(2)|D.C. Code § 2-102(a)(i)|D.C. Code § 2-102(a)(ii)",
    "42 U.S.C. 1983 and 42 U.S.C. 1984; 33 U.S. Code § 1267; 16 CFR 1002 and 5 CFR §1000": "16 CFR 1002|33 U.S.C. § 1267|42 U.S.C. § 1983|42 U.S.C. § 1984|5 CFR §1000",
    "D.C. Code 7-200.1; DC Code Section 7-671.02": "D.C. Code § 7-200.1|DC Code § 7-671.02",
    "DC Code § 1–621.5": "DC Code § 1-621.5",
    "42 U.S.C. 1983 to 1985 and 5 U.S.C. 1983-1984": "42 U.S.C. § 1983|42 U.S.C. § 1985|5 U.S.C. § 1983|5 U.S.C. § 1984",
    "16 CFR 1002 through 1004 and 12 CFR 34.5-34.6": "12 CFR 34.5|12 CFR 34.6|16 CFR 1002|16 CFR 1004",
    "D.C. Municipal Regulations 3-101 through 3-102 and D.C. Municipal Regulations 4-201-4-205": "D.C. Municipal Regulations § 3-101|D.C. Municipal Regulations § 3-102|D.C. Municipal Regulations § 4-201|D.C. Municipal Regulations § 4-205",
    "D.C. Code 8-202, 8-203, and 8-204, as amended by D.C. Official Code revisions": "D.C. Code § 8-202|D.C. Code § 8-203|D.C. Code § 8-204",
    "Mayor’s Order 2024-034: Establishment; Mayor's Order 2009-225; amended by 2013-154; MO 2016-083": "Mayor's Order 2009-225|Mayor's Order 2024-034",
    "D.C. Law 21-74. Higher Education; 2015-260; D.C. Act 21-386": "D.C. Act 21-386|D.C. Law 21-74",
    "No citation here": "",
}


def locators(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", ci.locators_of(F.col("t")).alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["i"])]


def test_locators(spark):
    assert ["|".join(v) for v in locators(spark, list(LOCATORS))] == list(LOCATORS.values())


def test_locators_of_nothing(spark):
    assert locators(spark, [None, "", "(a), (b) and §§ 1", "D.C. Code", "D.C. Code § (b), 1-2", "D.C. Code § and 1-2"]) == [[]] * 6


def test_lists_of_sections(spark):
    """Lists put together with what they must give: sections, their paragraphs, ranges with and without blanks, in several titles a text."""
    draw = random.Random(7)

    def listed(code):
        number = lambda: f"{draw.randint(1, 50)}-{draw.randint(100, 999)}" if code else str(draw.randint(100, 999))
        parts, found, base = [], [], None
        for _ in range(draw.randint(1, 5)):
            kind = draw.choice(["one", "one", "paragraph", "short", "range", "tight"])
            if kind == "short" and base:
                parts.append("(z)")
                found.append(base + "(z)")
            elif kind == "range":
                a, b = number(), number()
                parts.append(a + draw.choice([" to ", " through ", " - "]) + (b.split("-")[1] if code and draw.random() < 0.5 else b))
                base = b if parts[-1].endswith(b) and (not code or "-" in parts[-1].split()[-1]) else f"{a.split('-')[0]}-{b.split('-')[1]}"
                found += [a, base]
            elif kind == "tight":
                a = number()
                b = f"{a.split('-')[0]}-{draw.randint(100, 999)}" if code else number()
                parts.append(f"{a}-{b}")
                found += [a, b]
                base = b
            else:
                base = number()
                parts.append(base + ("(a)(1)" if kind == "paragraph" else ""))
                found.append(parts[-1])
                base += "(a)" if kind == "paragraph" else ""
        text = parts[0]
        for x in parts[1:]:
            text += draw.choice([", ", "; ", " and ", ", and ", ",", ", §§ "]) + x
        return text, found

    texts, want = [], []
    for _ in range(400):
        said, every = [], set()
        for _ in range(draw.randint(1, 3)):
            title, name = draw.choice([("D.C. Code", "D.C. Code § "), ("DC Official  Code", "DC Official Code § "), ("42 U.S.C.", "42 U.S.C. § "), ("7 CFR", "7 CFR ")])
            text, found = listed("C" in title and "D" in title)
            said.append(f"{title} {draw.choice(['§§ ', 'Sections ', ''])}{text}")
            every |= {name + x for x in found}
        texts.append("; ".join(said) + ".")
        want.append(sorted(every))
    wrong = [(t, w, g) for t, w, g in zip(texts, want, locators(spark, texts), strict=True) if w != g]
    assert not wrong, wrong[:2]
