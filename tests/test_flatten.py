import json
from xml.etree import ElementTree

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import flatten
from millrace.operators.flatten import (
    FOOD_COLUMNS,
    FOOD_FIELDS,
    flat_foods,
    flatten_foods,
    flatten_pets,
    food_elements,
)
from millrace.plans import flattening
from millrace.sinks import tables as tb
from millrace.sources.documents import read_xml_elements
from workload import inputs, queries

# The sample pets and foods whose flat rows are known.
PHOTO = "https://learnwebcode.github.io/json-example/images/"
PETS = {
    "pets": [
        {"name": "Purrsloud", "species": "Cat", "birthYear": 2016, "photo": PHOTO + "cat-2.jpg",
         "favFoods": ["wet food", "dry food", "<strong>any</strong> food"]},
        {"name": "Barksalot", "species": "Dog", "birthYear": 2008, "photo": PHOTO + "dog-1.jpg"},
        {"name": "Meowsalot", "species": "Cat", "birthYear": 2012, "photo": PHOTO + "cat-1.jpg",
         "favFoods": ["tuna", "catnip", "celery"]},
    ]
}

# name, maker, serving, calories, from fat, seven nutrients, two vitamins, two minerals
FOODS = """
Avocado Dip|Sunnydale|29|110|100|11|3|5|210|2|0|1|0|0|0|0
Bagels, New York Style |Thompson|104|300|35|4|1|0|510|54|3|11|0|0|8|20
Beef Frankfurter, Quarter Pound |Armitage|115|370|290|32|15|65|1100|8|0|13|0|2|1|6
Chicken Pot Pie|Lakeson|198|410|200|22|9|25|810|42|2|10|20|2|2|10
Cole Slaw|Fresh Quick|1.5|20|0|0|0|0|15|5|2|1|30|45|4|2
Eggs|Goodpath|50|70|40|4.5|1.5|215|65|1|0|6|6|0|2|4
Hazelnut Spread|Ferreira|2|200|90|10|2|0|20|23|2|3|0|0|6|4
Potato Chips|Lees|28|150|90|10|3|0|180|15|1|2|0|10|0|0
Soy Patties, Grilled|Gardenproducts|96|160|45|5|0|0|420|10|4|9|0|0|0|0
Truffles, Dark Chocolate|Lyndon's|39|220|170|19|14|25|10|16|1|1|0|0|0|0
"""
EXPECTED = [tuple(line.split("|")) for line in FOODS.strip("\n").split("\n")]


def food_xml(f):
    nutrients = ("total-fat", "saturated-fat", "cholesterol", "sodium", "carb", "fiber", "protein")
    body = "".join(f"<{n}>{v}</{n}>" for n, v in zip(nutrients, f[5:12]))
    return (
        f'<food><name>{f[0]}</name><mfr>{f[1]}</mfr><serving units="g">{f[2]}</serving>'
        f'<calories total="{f[3]}" fat="{f[4]}"/>{body}'
        f"<vitamins><a>{f[12]}</a><c>{f[13]}</c></vitamins>"
        f"<minerals><ca>{f[14]}</ca><fe>{f[15]}</fe></minerals></food>\n"
    )


DAILY = '<daily-values><carb units="g">300</carb></daily-values>'
DOCUMENT = '<?xml version="1.0"?>\n<nutrition>' + DAILY + "".join(map(food_xml, EXPECTED)) + "</nutrition>"


def documents(spark, *texts, column="xml_data"):
    return spark.createDataFrame([(t,) for t in texts], f"{column} STRING")


def as_text(row):
    return tuple(str(v) if v is not None else None for v in row)


def test_pets(spark, rows):
    flat = flatten_pets(documents(spark, json.dumps(PETS), column="json_data"))
    assert flat.columns == ["name", "species", "birth_year", "photo", "fav_foods"]
    expected = [
        (p["name"], p["species"], p["birthYear"], p["photo"],
         json.dumps(p["favFoods"]) if "favFoods" in p else None)
        for p in PETS["pets"]
    ]
    assert rows(flat) == sorted(expected, key=repr)


def test_pets_edges(spark, rows):
    texts = [
        "{}",
        '{"pets": []}',
        '{"pets": [{"name": "n", "favFoods": [], "species": true}]}',
        '{"pets": [{"name": "m", "favFoods": ["рыба"], "birthYear": ""}]}',
    ]
    assert rows(flatten_pets(documents(spark, *texts, column="json_data"))) == [
        ("m", None, None, None, json.dumps(["рыба"])),
        ("n", "true", None, None, None),
    ]


def test_bad_pet_input_fails(spark):
    for bad in ('{"pets": [{"birthYear": "old"}]}', '{"pets": '):
        with pytest.raises(Exception):
            flatten_pets(documents(spark, bad, column="json_data")).collect()


def test_foods(spark):
    flat = flatten_foods(documents(spark, DOCUMENT))
    assert tuple(flat.columns) == FOOD_COLUMNS
    assert dict(flat.dtypes)["calories_fat"] == "int"
    assert [as_text(r) for r in flat.collect()] == EXPECTED


def test_food_edges(spark):
    text = (
        "<nutrition><food><name>first</name><name>second</name><mfr></mfr>"
        '<calories total="1" fat=""/><vitamins><c>4</c></vitamins></food></nutrition>'
    )
    got = flatten_foods(documents(spark, text)).first()
    assert (got.food_name, got.manufacturer, got.calories_total, got.calories_fat) == ("first", None, 1, None)
    assert (got.vitamin_a, got.vitamin_c, got.calcium, got.iron) == ("0", "4", "0", "0")


def test_deeper_foods(spark):
    text = f"<nutrition><part>{food_xml(EXPECTED[0])}</part><part>{food_xml(EXPECTED[5])}</part></nutrition>"
    df = documents(spark, text, DOCUMENT)
    found = [as_text(r) for r in flatten_foods(df).collect()]
    assert sorted(found, key=repr) == sorted([EXPECTED[0], EXPECTED[5], *EXPECTED], key=repr)


def test_fields_at_any_depth(spark):
    text = (
        "<n><group><food><info><name>deep</name></info><mfr>direct</mfr>"
        "<nested><vitamins><a>3</a></vitamins><calories total='7' fat='2'/></nested></food></group>"
        "<food><name>plain</name></food><food/></n>"
    )
    got = {r.food_name: r for r in flatten_foods(documents(spark, text)).collect()}
    assert set(got) == {"deep", "plain", None}
    deep = got["deep"]
    assert (deep.manufacturer, deep.vitamin_a, deep.calories_total, deep.calories_fat) == ("direct", "3", 7, 2)


NESTED = (
    "<n><food id='1'><x><food><name>in</name><mfr>m</mfr><food/></food></x><name>out</name>"
    "<calories total='9' fat='1'/></food><!-- <food><name>no</name></food> --><food\n><name>é <![CDATA[<food>]]></name></food ></n>"
)


def by_tree(text):
    """Names and makers of all foods in document order, by a parsed tree."""
    found = []
    for food in ElementTree.fromstring(text).iter("food"):
        texts = [next((e.text for e in food.iter(n) if e.text), None) for n in ("name", "mfr")]
        found.append((*texts, next((int(e.get("total")) for e in food.iter("calories")), None)))
    return found


def test_foods_in_foods(spark, rows):
    wanted = by_tree(NESTED)
    assert len(wanted) == 4
    flat = flatten_foods(documents(spark, NESTED, DOCUMENT, NESTED))
    got = [r for r in rows(flat, "food_name", "manufacturer", "calories_total") if r[0] not in {e[0] for e in EXPECTED}]
    assert got == sorted(wanted * 2, key=repr)
    assert flat.count() == 8 + len(EXPECTED)


@given(st.recursive(st.sampled_from(["<name>a</name>", "<mfr>b</mfr>", "<food/>", "t", "<!--<food>-->"]),
                    lambda inner: st.tuples(st.sampled_from(["food", "x", "foods"]), st.lists(inner, max_size=4)).map(
                        lambda p: f"<{p[0]}>{''.join(p[1])}</{p[0]}>"), max_leaves=25))
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_nesting(spark, body):
    text = f"<n>{body}</n>"
    found = food_elements(documents(spark, text)).collect()
    trees = [ElementTree.canonicalize(ElementTree.tostring(f, encoding="unicode").strip()) for f in trees_of(text)]
    assert sorted(ElementTree.canonicalize(r.food_xml) for r in found) == sorted(trees)


def trees_of(text):
    for food in ElementTree.fromstring(text).iter("food"):
        food.tail = None
        yield food


def test_foods_at_any_depth_in_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(f"<n><x><y>{food_xml(EXPECTED[1])}</y></x>{food_xml(EXPECTED[2])}</n>")
    foods = read_xml_elements(spark, str(tmp_path), "food", FOOD_FIELDS)
    assert [as_text(r) for r in flat_foods(foods).collect()] == EXPECTED[1:3]


def test_malformed_foods_fail_unless_lenient(spark):
    df = documents(spark, "<nutrition><food>")
    with pytest.raises(Exception):
        flatten_foods(df).collect()
    assert flatten_foods(df, strict=False).count() == 0
    df = documents(spark, '<n><food><calories total="many"/></food></n>')
    with pytest.raises(Exception):
        flatten_foods(df).collect()
    assert flatten_foods(df, strict=False).first().calories_total is None


def test_tables_append_or_overwrite(spark, database):
    pets, foods = flattening.PETS.in_database(database), flattening.FOODS.in_database(database)
    source = documents(spark, json.dumps(PETS), column="json_data")
    for _ in range(2):
        flattening.load_pets(spark, source, pets)
    assert tb.read(spark, pets).count() == 6
    flattening.load_pets(spark, source, pets, mode="overwrite")
    stored = tb.read(spark, pets)
    assert stored.count() == 3
    assert stored.where(F.col("processed_at").isNull()).count() == 0
    flattening.load_foods(spark, documents(spark, DOCUMENT), foods)
    assert tb.read(spark, foods).count() == 10
    with pytest.raises(ValueError):
        flattening.load_pets(spark, source, pets, mode="ignore")


def test_documents_are_dealt_before_they_are_searched(spark):
    """A scan of few tasks must not do the work on all texts."""
    documents = inputs.food_documents(spark, "/root/testdata/sf0.001")
    plan = food_elements(documents)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    dealt = [i for i, line in enumerate(plan) if "RebalancePartitions" in line]
    assert len(dealt) >= 2
    for i in dealt:
        depth = plan[i].index("Rebalance")
        below = []
        for line in plan[i + 1 :]:
            if len(line) - len(line.lstrip(" :+-")) <= depth:
                break
            below.append(line)
        assert below and not any("regexp" in line for line in below)


def test_xml_files_are_small(spark, monkeypatch):
    """One task reads a file, so none may grow with the table."""
    read = {}

    def reading(spark, path, *rest):
        read["files"] = spark.read.text(path, wholetext=True).collect()
        return read_xml_elements(spark, path, *rest)

    monkeypatch.setattr(queries, "read_xml_elements", reading)
    monkeypatch.setattr(queries, "FOODS_PER_FILE", 20)
    foods = queries.flatten_xml_files(spark, "/root/testdata/sf0.001").count()
    counts = [r[0].count("<food>") for r in read["files"]]
    assert sum(counts) == foods and max(counts) <= 20


def test_tags_of_foods_alone_are_scanned_one_by_one(spark):
    """What stands between two of them is one piece, however much it is."""
    filler = "".join(f"<!-- <food> {i} --><x{i}>t</x{i}><![CDATA[</food>]]>" for i in range(3000))
    text = f"<n>{filler}<food><name>a</name>{filler}<food/><foods/><food ><name>b</name></food >{filler}</food></n>"
    docs = spark.createDataFrame([(text,)], "xml_data string")
    found = sorted((r["food_xml"] for r in food_elements(docs).collect()), key=len)
    assert found[:2] == ["<food/>", "<food ><name>b</name></food >"]
    assert found[2].startswith("<food><name>a</name><!--") and found[2].endswith("</food>") and len(found) == 3
    pieces = docs.select(F.size(F.regexp_extract_all("xml_data", F.lit(flatten._TOKEN), F.lit(0)))).first()[0]
    assert pieces <= 11
