import pytest
from pyspark.sql import functions as F

from tallyweave.functions import normal, script, text


def frame(spark, rows):
    return normal.normalise_frame(spark.createDataFrame([(f"S1-{i}", *r) for i, r in enumerate(rows)], "entity_id string, business_name string, business_address string, country string"))


def expressions(spark, rows, *columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{j} string" for j in range(len(rows[0]))))
    out = df.select("i", *[c.alias(f"x{j}") for j, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1:] for r in out]


def test_clean(spark):
    cases = {
        "  ＡＣＭＥ   Ｉｎｃ  ": "acme inc", "CEDAR STREET, null, MONTICELLO, IA": "cedar street, monticello, ia", "Fairfield, Bldg N/A, 138 Armstrong Street": "fairfield, bldg, 138 armstrong street",
        "-- Sulphur Clinic Co": "sulphur clinic co", "<< Team Ecole": "team ecole", "FN () Private Limited": "fn private limited", "NO 186 1 NIL JAYPUR": "no 186 1 jaypur",
        "Jalandhar - I Communications": "jalandhar i communications", "N0032 N/A N/A K N Roy Road": "n0032 k n roy road", "null": "", "a 　b": "a b",
    }
    assert [x for (x,) in expressions(spark, [(k,) for k in cases], normal.clean_expr(F.col("c0")))] == list(cases.values())
    assert normal.one(spark, normal.clean_expr, None) == ""


def test_legal_suffix_and_street(spark):
    cases = [
        ("raj investments llp", "India", "raj investments", "llp"), ("ss food private limited", "India", "ss food", "private limited"), ("acme pvt ltd", "India", "acme", "pvt ltd"),
        ("sharma and co", "India", "sharma", "and co"), ("boyd newtekone llc", "US", "boyd newtekone", "llc"), ("stag inc", "US", "stag", "inc"), ("znb club sarl", "France", "znb club", "sarl"),
        ("sarl ehpad club", "France", "ehpad club", "sarl"), ("private limited", "India", "private limited", ""), ("acme sarl", "US", "acme sarl", ""), ("acme l l c", "US", "acme", "l l c"),
    ]
    assert expressions(spark, [c[:2] for c in cases], *normal.legal_suffix(F.col("c0"), F.col("c1"))) == [c[2:] for c in cases]
    streets = {
        "1536 biggs street amarillo tx": "1536 biggs st amarillo tx", "617 rock hill church road": "617 rock hill church rd", "12 saint marks avenue": "12 st marks ave",
        "9 sunset boulevard suite 4 floor 2": "9 sunset blvd ste 4 fl 2", "po box 77 pine lane": "pobox 77 pine ln", "p o box 5 main drive apartment 3": "pobox 5 main dr apt 3", "1 king court highway 9 square": "1 king ct hwy 9 sq",
    }
    assert [x for (x,) in expressions(spark, [(k,) for k in streets], normal.street(F.col("c0")))] == list(streets.values())


def test_scripts(spark):
    cases = {"": 0, "123 - ,": 0, "Acme Inc": 1, "Énterprises": 1, "विजय": 2, "রাম": 3, "ਸਿਲਵਰ": 4, "શિવમ": 5, "ଶିବ": 6, "ஜைன்": 7, "గురు": 8, "ರಾಮ್": 9, "ശക്തി": 10, "Smart नॉर्थ कंसल्टेंट्स Private Limited": 2, "Москва": 15, "සිංහල": 15}
    assert [x for (x,) in expressions(spark, [(k,) for k in cases], text.script_of(F.col("c0")))] == list(cases.values())
    words = {"विजय प्रोजेक्ट्स प्राइवेट लिमिटेड": "vijay projekts praivet limited", "ரா": "ra", "Acme 12": "Acme 12", "महाराष्ट्र": "maharashtr", "दिल्ली": "dilli", "क़": "q", "": "", "සිංහල": ""}
    assert [x for (x,) in expressions(spark, [(k,) for k in words], script.romanise(F.col("c0")))] == list(words.values())
    assert all(script.romanised(chr(c)).isascii() for c in range(0x900, 0xE00))


ADDRESSES = [
    ("H.No.8-2-293/82/C/16/A, Road No.07, Jubilee Hills, Telangana, Plot No.16 3Rd Floor, Susheela Pride", "India", {"street_num": "8-2-293/82/c/16/a"}),
    ("D.No.20-6-211/1, Shah Ali Banda, Hyderabad, Telangana", "India", {"street_num": "20-6-211/1", "city_norm": "hyderabad", "state_canon": "tg"}),
    ("B-1/313-E Ground Floor Gali No.10, New Ashok Nagar, Delhi, East Delhi, Delhi", "India", {"street_num": "b-1/313-e"}),
    ("#216, 1St Main, Sapthagiri Residency, Muthurayanagar, Mysore Road, Bangalore, Karnataka", "India", {"street_num": "216", "city_norm": "bangalore", "state_canon": "ka"}),
    ("FL NO 00302, SHIVANI RESIDENCY S NO 29, PUNE CITY, महाराष्ट्र", "India", {"city_norm": "pune city", "state_canon": "mh"}),
    ("148, EAST DELHI, SHAHDARA, Delhi", "India", {"city_norm": "shahdara", "state_canon": "dl"}), ("Kolkata, 7, Brabourne Road, WB", "India", {"city_norm": "kolkata", "state_canon": "wb"}),
    ("12, MG Road, Tamilnadu", "India", {"city_norm": "", "state_canon": "tn"}),
    ("2621 Cotten Road, Tyler, TX", "US", {"street_num": "2621", "city_norm": "tyler", "state_canon": "tx", "postcode": ""}),
    ("IA, Iowa City, 1064 Newton Rd, Unit 11", "US", {"street_num": "1064", "city_norm": "iowa city", "state_canon": "ia", "postcode": ""}),
    ("KANSAS CITY, MO, 630 45ND TERRACE, null", "US", {"street_num": "630", "city_norm": "kansas city", "state_canon": "mo", "postcode": ""}),
    ("1536 Biggs St, Texas, Amarillo", "US", {"street_num": "1536", "city_norm": "amarillo", "state_canon": "tx"}),
    ("273 Big Station Camp Boulevard, Unit 13103, Gallatin, TN", "US", {"street_num": "273", "city_norm": "gallatin", "state_canon": "tn", "postcode": ""}),
    ("55 Main St, Springfield, IL 62701", "US", {"street_num": "55", "city_norm": "springfield", "state_canon": "il", "postcode": "62701"}),
    ("12 Foo Road, Springfield, ZZ", "US", {"state_canon": "zz", "city_norm": "springfield"}),
    ("14 RUE DIMU, 33000 BORDEAUX, BORDEAUX, Gironde", "France", {"street_num": "14", "postcode": "33000"}),
    ("59430 DUNKERQUE, 11 R DU MARÉCHAL FOCH, DUNKERQUE", "France", {"street_num": "11", "postcode": "59430"}),
    ("00133 R CROIX DE SEGUEY, BORDEAUX, Gironde", "France", {"street_num": "00133", "postcode": ""}),
    ("Near Old Bus Stand", "India", {"street_num": "", "state_canon": "", "postcode": "", "has_addr": True}), (None, None, {"street_num": "", "city_norm": "", "has_addr": False, "country": ""}),
]


def test_address_components(spark):
    got = {r.entity_id: r for r in frame(spark, [("x", a, c) for a, c, _ in ADDRESSES]).collect()}
    for i, (address, _, want) in enumerate(ADDRESSES):
        assert {k: got[f"S1-{i}"][k] for k in want} == want, address
        if want.get("street_num"):
            assert want["street_num"] in got[f"S1-{i}"].addr_tokens


def test_frame(spark):
    out = frame(spark, [("Raj Investments LLP", "12, MG Road, null, महाराष्ट्र", "India"), ("विजय प्रोजेक्ट्स प्राइवेट लिमिटेड", "", "India"), ('"ehpad Club SAS', "4 Rue Daurat, Saint-Nazaire", "France"), (None, None, None)])
    assert tuple(out.columns) == normal.NORM
    a, b, c, d = sorted(out.collect(), key=lambda r: r.entity_id)
    assert (a.street_num, a.name_acronym, a.name_suffix, a.has_addr, a.script) == ("12", "ri", "llp", True, 1 + 16 * 2)
    assert (b.name_roman, b.name_suffix, b.has_addr, b.script) == ("vijay projekts", "praivet limited", False, 2)
    assert c.name_norm.startswith('"') and c.name_roman == "ehpad club" and c.name_tokens == ["ehpad", "club"] and c.name_suffix == "sas"
    assert d.name_norm == "" and d.name_tokens == [] and d.name_acronym == ""
    assert normal.normalise_frame(spark.createDataFrame([], "entity_id string, business_name string, business_address string, country string")).count() == 0


@pytest.mark.parametrize("name,country", [("Acme", None)])
def test_one_record(spark, name, country):
    assert normal.normalise_record(spark, name, None, country)["name_roman"] == "acme"
    assert dict(((r.country, r.alpha), r.state) for r in normal.state_table(spark).collect())["US", "arizona"] == "az"
