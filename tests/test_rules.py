"""Rule tables: raw value to expected value, worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.functions import geo, listing, text, vehicle
from listingflow.operators import quality
from listingflow.streaming import incremental

C = F.col


def check(spark, make, table):
    """table: list of (inputs…, expected)."""
    width = len(table[0]) - 1
    schema = ", ".join(f"c{i} string" for i in range(width)) + ", n int"
    df = spark.createDataFrame([(*row[:-1], i) for i, row in enumerate(table)], schema)
    got = {r.n: r.out for r in df.select("n", make(*[C(f"c{i}") for i in range(width)]).alias("out")).collect()}
    assert {i: got[i] for i in got} == {i: row[-1] for i, row in enumerate(table)}


CASES = {
    "gearbox": (vehicle.gearbox, [
        ("6挡手自一体", "自动"), ("7挡双离合", "自动双离合"), ("CVT无级变速(模拟8挡)", "自动"), ("5挡手动", "手动"),
        ("电动车单速变速箱", "-"), ("2.0L MT豪华", "手动"), ("6AT", "自动"), ("AMT智能手动", "自动"), ("自动DSG", "自动"), (None, None)]),
    "emission": (lambda n, r: vehicle.emission_standard(n, r), [
        (None, "国VI", "国六"), (None, "国V", "国五"), (None, "国IV", "国四"), (None, "国III", "国三"), (None, "国4+OBD", "国四"),
        (None, "国4带OBD", "国四"), (None, "欧4(国3)", "欧四/国三"), ("某车 国IV 豪华", "-", "国四"), ("某车 豪华", "-", None)]),
    "emission production": (vehicle.emission_standard_production, [
        ("国VI(国V)", "国六/国五"), ("未知", "-"), ("国4+OBD", "国四")]),
    "displacement": (lambda n, r: vehicle.displacement(n, r), [
        (None, "1.8L", "1.8"), ("2.0T 豪华", "1998mL", "2.0"), ("某车 1.5T", "-", "1.5"), ("某车", "-", None)]),
    "power": (lambda f, e: vehicle.power_code(f, e == "yes"), [
        ("纯电动", "no", 1), ("油电混合", "no", 2), ("插电式混合动力", "no", 3), ("增程式", "no", 4), ("汽油", "yes", 1), ("汽油", "no", 0),
        (None, "no", 0)]),
    "color": (listing.color, [
        ("深灰色", "灰"), ("其他", "其它"), ("无数据", ""), ("象牙白", "白"), ("冰川蓝", "蓝"), ("香槟-色", "香槟"), (None, "")]),
    "fee": (listing.transfer_fee, [("不含过户费", "0"), ("含过户费", "1"), ("面议", "面议"), (None, "")]),
    "expiry": (lambda e: listing.expiry_flag(F.lit("2024-05-01"), e), [
        ("2024-04-01", "1"), ("2024-05-01", "0"), ("2024-06-01", "0"), ("", ""), ("bad", ""), (None, "")]),
    "level": (vehicle.car_level, [("紧凑型SUV", "紧凑型SUV"), ("中大型车", "中大型车"), ("豪华", "无"), (None, "无")]),
    "year": (vehicle.model_year_from_name, [("2020款 x", "2020"), ("19款 x", "19"), ("x", ""), (None, None)]),
    "status": (vehicle.sale_status, [("停产在售", "在售"), ("怪", "怪"), (None, None)]),
    "id": (text.id_key, [("12", "12"), (" 12.0 ", "12"), ("x", None), (None, None)]),
    "drive": (vehicle.drive, [("AWD", "四驱"), ("2WD", "两驱"), ("后驱", "后驱")]),
}


# Every rule of the ordered lists by a text that only it changes: an altered pattern fails here, whatever the SQL says.
EACH_RULE = {
    "gearbox": (vehicle.gearbox, [
        *[(x, "自动") for x in (
            "CVT无级变速", "无级变速", "自动8挡CVT", "CVT8挡自动", "-CVT", "CVT", "双离合7挡手自动一体", "手自一体型", "手自动一体型", "手自动一体", "手自一体",
            "tiptronic", "6速 AT x", "-6AT", "AT 豪华", "AT-x", "AT", "AMT智能手动版", "AMT智能手动", "AMT", "EMT", "IMT")],
        *[(x, "自动双离合") for x in ("DSG双离合", "双离合器", "双离合", "G-DCT", "DCT", "DSG")],
        *[(x, "手动") for x in ("MT", "5MT", "MT-x", "x MT豪华", "manual 5", "Manual", "MANUAL", "手动")],
        *[(x, "-") for x in ("ATX", "xMTx", "单速", "", "aManual")]]),
    "emission": (lambda n, r: vehicle.emission_standard(n, r), [
        *[(None, "国" + x, "国三") for x in ("3", "III", "Ⅲ", "三", "3化油器", "3+OBD", "3带OBD", "3)")],
        *[(None, "国" + x, "国二") for x in ("2", "Ⅱ", "II")], *[(None, "欧" + x, "欧四") for x in ("4", "IV", "Ⅳ")],
        *[(None, "京" + x, "京六") for x in ("6", "VI", "Ⅵ")], *[(None, "国" + x, "国五") for x in ("5", "V", "Ⅴ")],
        *[(None, "国" + x, "国一") for x in ("1", "I", "Ⅰ")], (None, "国4(京5)", "国四/京五"),
        ("某 京五 x", "无", "京五"), ("某 欧Ⅳ型 x", "", "欧四型"), ("某 国2 x", "-", "国二"), ("某 国Ⅵ", "-", "国六"), ("国", "-", None)]),
    "emission production": (vehicle.emission_standard_production, [
        *[("国" + x, "国三") for x in ("3", "III", "Ⅲ", "3+OBD", "3)")], *[("国" + x, "国二") for x in ("2", "Ⅱ", "II")],
        *[("国" + x, "国四") for x in ("4", "IV", "Ⅳ")], *[("国" + x, "国六") for x in ("6", "VI", "Ⅵ")], *[("国" + x, "国五") for x in ("5", "V")],
        ("国4(国5)", "国四/国五"), ("未知", "-"), ("国I", "国I")]),
    "color": (listing.color, [
        ("――", ""), ("白-", "白"), ("无数据", ""), ("null", ""), ("红09", "红"), ("其他", "其它"), ("红色", "红"), ("浅灰", "灰"), ("深蓝", "蓝"),
        ("象牙", ""), ("冰川", ""), ("其他色", "其它")]),
    "color catalogue": (vehicle.catalogue_color, [("无", ""), ("黑;白;;", "黑;白"), ("a;b", "a;b")]),
    "gearbox match": (vehicle.gearbox_for_match, [
        ("CVT无级变速", "自动"), ("无级变速", "自动"), ("CVT", "自动"), ("双离合", "自动双离合"), ("手自一体", "自动"), ("Auto 6", "自动"), ("automatic", "自动"),
        ("Manual 5", "手动"), ("manual", "手动"), (None, "")]),
    "drive": (vehicle.drive, [*[(x, "四驱") for x in ("四驱", "AWD", "4WD", "4X4", "4x4")], *[(x, "两驱") for x in ("两驱", "FWD", "RWD", "2WD")]]),
}


@pytest.mark.parametrize("name", EACH_RULE)
def test_each_rule_of_an_ordered_list(spark, name):
    make, table = EACH_RULE[name]
    check(spark, make, table)


def test_each_rule_of_the_electric_block_and_the_flags(spark):
    def block(column, table):
        df = spark.createDataFrame([(raw, i) for i, (raw, _) in enumerate(table)], f"{column} string, n int")
        got = {r.n: r[column] for r in vehicle.ev_block(df).collect()}
        assert got == {i: want for i, (_, want) in enumerate(table)}

    block("ee_type", [("a / b", "ab"), ("前x后y", "前x/后y")])
    for time in ("ee_fast_charging_time", "ee_slow_charging_time"):
        block(time, [("标配", "-"), ("选配", "-"), ("待查", "-"), ("0.5", "0.5")])
    kinds = ("三元镍钴锰酸锂", "磷酸铁锂", "三元锂", "锂离子", "钴酸锂", "锰酸锂", "镍钴锰", "高压锂", "镍氢")
    block("ee_battery_type", [*[(f"x{k}y", f"{k}电池") for k in kinds], ("铅", "-"), (None, "-")])
    block("ee_pure_electric_range", [("标配", "-"), ("选配", "-"), ("500km", "500"), ("500公里", "500")])
    block("ee_battery_quality_assurance", [
        ("三年", "3年"), ("四年", "4年"), ("五年", "5年"), ("六年", "6年"), ("八年", "8年"), ("十年", "10年"), ("待查", "-"), ("3年 或 5年", "3年5年")])
    flags = [("前标配", "Y"), ("后标配", "Y"), ("主标配", "Y"), ("副标配", "Y"), ("标配", "Y"), ("前选配", "N"), ("后选配", "N"), ("主选配", "N"), ("副选配", "N"),
             ("选配", "N"), ("前无", "N"), ("后无", "N"), ("主无", "N"), ("副无", "N"), ("无", "N"), ("前-", "N"), ("后-", "N"), ("主-", "N"), ("副-", "N"), ("-", "N")]
    df = spark.createDataFrame([(raw, i) for i, (raw, _) in enumerate(flags)], "abs string, n int")
    assert {r.n: r.abs for r in vehicle.equipment_flags(df).collect()} == {i: want for i, (_, want) in enumerate(flags)}


@pytest.mark.parametrize("name", CASES)
def test_column_rule(spark, name):
    make, table = CASES[name]
    check(spark, make, table)


def test_ev_block(spark):
    def one(column, raw):
        df = spark.createDataFrame([(raw,)], f"{column} string")
        return vehicle.ev_block(text.blank_to_dash(df)).first()[0]

    assert one("ee_type", "永磁/同步") == "永磁同步"
    assert one("ee_type", "前异步/后永磁") == "前异步/后永磁"
    assert one("ee_battery_type", "三元锂电池") == "三元锂电池"
    assert one("ee_battery_type", "铅酸") == "-"
    assert one("ee_pure_electric_range", "510km") == "510"
    assert one("ee_battery_quality_assurance", "八年或12万公里") == "8年12万公里"
    assert one("ee_battery_quality_assurance", "十五年") == "105年"
    assert one("ee_fast_charge", "80") == "80%"
    assert one("ee_fast_charge", "-") == "-"
    assert one("ee_fast_charge", "") == "-"
    assert one("ee_fast_charge", None) == "-"


def test_equipment_flags(spark):
    raws = ["标配", "前标配", "选配", "-", "无", "前-", "主标配/副标配", None]
    df = spark.createDataFrame([(r,) for r in raws], "abs string")
    assert [r[0] for r in vehicle.equipment_flags(df).collect()] == ["Y", "Y", "N", "N", "N", "N", "Y/Y", None]


def test_plain_equipment_values_equal_the_rules(spark):
    df = spark.createDataFrame([(v,) for v in V.EQUIPMENT_PLAIN], "v string")
    got = {r[0]: r[1] for r in df.select("v", text.fold_rules(C("v"), V.EQUIPMENT_RULES)).collect()}
    assert got == V.EQUIPMENT_PLAIN


def test_pair_split(spark):
    rows = [("主标配\\/副标配", "主标配\\/副标配"), ("主标配?\\/副标配", "主标配\\/\\副标配"), ("主标配/副标配", "主标配/副标配")]
    got = vehicle.split_pairs(spark.createDataFrame(rows, "master_air_bag string, sub_air_bag string")).collect()
    assert [tuple(r) for r in got] == [("主标配", "副标配"), ("主标配", "副标配"), ("主标配/副标配", "主标配/副标配")]


def test_import_naming(spark):
    rows = [("X5(进口)", "宝马"), ("X5(进口)", "进口宝马"), ("e级(停售)", "北京奔驰")]
    df = spark.createDataFrame(rows, "series_name string, series_group_name string")
    got = [(r.series_name, r.series_group_name, r.is_import) for r in vehicle.import_naming(df).collect()]
    assert got == [("X5", "进口宝马", 1), ("X5", "进口宝马", 1), ("E级", "北京奔驰", 0)]


def test_text_defaults(spark):
    df = spark.createDataFrame([("暂无数据", "NA"), ("3次", "1"), (None, None)], "transfer string, annual string")
    assert [tuple(r) for r in listing.text_defaults(df).collect()] == [("", ""), ("3次", "1"), ("", "")]


def test_age(spark):
    row = spark.range(1).select(
        listing.reg_month(F.lit("2020-03-15")).alias("m"),
        listing.age_years(F.lit("2024-05-11"), listing.reg_month(F.lit("2020-03-15"))).alias("y")).first()
    assert (row.m, row.y) == ("2020-03", 4.2)


def test_listing_sanity(spark):
    rows = [(10, 20, 3, "2020-05", True), (1, 20, 3, "2020-05", False), (30, 20, 0.5, "2020-05", False), (22, 20, 0.5, "2020-05", True),
            (22, 20, 3, "2020-05", False), (10, 0, 3, "2020-05", False), (10, 20, 3, "2000-01", False), (10, 20, 3, "bad", False)]
    df = spark.createDataFrame([(float(q), float(g), float(a), r, k) for q, g, a, r, k in rows],
                               "q double, g double, a double, r string, keep boolean")
    kept = df.where(quality.listing_ok(C("q"), C("g"), C("a"), C("r"), "2024-06-01"))
    assert sorted(map(tuple, kept.collect())) == sorted(
        (float(q), float(g), float(a), r, k) for q, g, a, r, k in rows if k)


def test_price_gap(spark):
    rows = [("20", "18", True), ("0", "18", False), ("20", "5", True), ("20", "4", False), ("5", "16", False), ("x", "1", False)]
    df = spark.createDataFrame(rows, "g string, p string, keep boolean")
    assert {tuple(r) for r in df.where(quality.price_gap_ok(C("g"), C("p"))).collect()} == {r for r in rows if r[2]}


def test_month_anchor():
    assert incremental.month_anchor("2024-03-03", 5, 1) == dt.date(2024, 2, 1)
    assert incremental.month_anchor("2024-03-24", 8, 20) == dt.date(2024, 3, 20)
    assert incremental.month_anchor("2024-03-24", 0, 15) == dt.date(2024, 3, 15)


def districts(spark):
    return spark.createDataFrame(
        [("东北", "吉林", "长春", "榆树"), ("东北", "吉林", "吉林", "舒兰"), ("东北", "吉林", "吉林", "榆树"), ("华东", "江苏", "南京", None)],
        "regional string, province string, city string, key_county string")


@pytest.mark.parametrize("limit", [geo.MAX_PATTERN_WORDS, 0])
def test_city(spark, limit):
    places = geo.Gazetteer.load(districts(spark), limit)
    rows = [("吉林长春", "吉林"), ("榆树市", "吉林"), ("未知", None), ("", None), (None, None), ("南京 榆树", "南京")]
    df = spark.createDataFrame([(a, i) for i, (a, _) in enumerate(rows)], "city string, n int")
    got = {r.n: r.city for r in geo.standardise_city(df, "city", places).collect()}
    assert got == {i: b for i, (_, b) in enumerate(rows)}


def test_listing_location_fallback_is_blank(spark):
    places = geo.Gazetteer.load(districts(spark))
    df = spark.createDataFrame([("x", "y", 1), ("x", "舒兰县", 2), (None, "南京", 3)], "location string, address string, n int")
    full = {r.n: r.location for r in geo.standardise_listing_location(df, places, county_fallback=True).collect()}
    plain = {r.n: r.location for r in geo.standardise_listing_location(df, places).collect()}
    assert full == {1: "", 2: "吉林", 3: "南京"}
    assert plain == {1: None, 2: None, 3: "南京"}


def test_pattern_prefers_the_longest_word():
    import re

    words = ["NATION_1", "NATION_10", "NATION_1 B", "吉林", "吉林市", "a.b", "a"]
    rx = re.compile(geo.words_pattern(words))
    for w in words:
        assert rx.search(f"xx{w}yy").group(0) == w
    assert rx.search("acb").group(0) == "a"


def test_empty_dictionary_gives_null(spark):
    for limit in (geo.MAX_PATTERN_WORDS, 0):
        places = geo.Gazetteer.load(districts(spark).limit(0), limit)
        assert geo.standardise_city(spark.createDataFrame([("吉林",)], "city string"), "city", places).first()[0] is None


def test_layouts():
    assert len(V.EQUIPMENT_COLUMNS) == 38
    assert len(V.DETAIL_COLUMNS) == 74
    assert len(V.LISTING_COLUMNS) == 34
    from listingflow import schemas as S

    assert len(S.PROD_CONFIG) == 88
    assert S.keys_of(S.LISTING_WIDE) == ["car_platform", "id_data_input"]
    assert S.defaults_of(S.ODS_BRAND) == {"car_country": "无"}
