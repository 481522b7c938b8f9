"""CSV folders, type declarations and the load job."""

import random

import pytest

from cartwise.operators.quality import check_tables, profile
from cartwise.plans.load import load_folder
from cartwise.schemas import ENTITIES, entity_for, shared_prefixes
from cartwise.sources import csv_files, tables


@pytest.fixture
def folder(tmp_path):
    files = {
        "shop_customers_dataset.csv": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,p1,01037,sao paulo,SP\nc2,p1,09790,NA,SP\n",
        "shop_sellers_dataset.csv": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,00999,campinas,SP\n",
        "shop_orders_dataset.csv": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at\n"
        "o1,c1,delivered,2017-10-02 10:56:33,\no2,c2,shipped,2018-01-01 00:00:00,soon\n",
        "shop_order_reviews_dataset.csv": "review_id,order_id,review_score,review_comment_title,review_comment_message\n"
        'r1,o1,4,,"two\nlines, ""quoted"""\nr2,o1,5,None,ok\nr2,o2,5,,ok\n',
        "shop_geolocation_dataset.csv": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
        "01037,-23.5,-46.6,sao paulo,SP\n01037,-23.7,-46.8,são paulo,SP\n09790,-1,-1,x,SP\n09790,-1,-1,x,SP\n",
        "brazil_states.csv": "abbreviation,state ,capitol_city ,region ,size_km2,perc_pop_urb\nSP,São Paulo,São Paulo ,Southeast,248209,93.7\n",
        "product_category_name_translation.csv": "﻿product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n",
        "extra.csv": "a,b\n1,x\n2,NA\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_table_names():
    assert csv_files.table_name("shop_orders_dataset.csv") == "shop_orders"
    assert csv_files.table_name("shop_geolocation_dataset_bis.csv") == "shop_geolocation_bis"
    prefixes = shared_prefixes(["shop_orders", "shop_customers", "best_sellers"])
    assert prefixes == {"shop_"}
    assert entity_for("shop_orders_2017", prefixes).name == "orders" and entity_for("states").name == "brazil_states"
    assert entity_for("best_sellers", prefixes) is entity_for("reorders", prefixes) is None


def test_folder_becomes_tables(spark, folder):
    loaded = csv_files.read_folder(spark, folder)
    assert len(loaded) == 8
    customers = loaded["customers"].orderBy("customer_id").collect()
    assert [(r.customer_zip_code_prefix, r.customer_city) for r in customers] == [("01037", "sao paulo"), ("09790", None)]
    states = loaded["brazil_states"]
    assert states.columns[:4] == ["abbreviation", "state", "capitol_city", "region"]
    assert dict(states.dtypes)["size_km2"] == "bigint"
    assert states.first().capitol_city == "São Paulo "
    assert loaded["product_category_name_translation"].columns[0] == "product_category_name"
    assert dict(loaded["extra"].dtypes) == {"a": "bigint", "b": "string"}
    assert loaded["extra"].where("b IS NULL").count() == 1


def test_quoted_line_breaks(spark, folder):
    reviews = csv_files.read_folder(spark, folder, "shop_order_reviews_dataset.csv")["order_reviews"]
    texts = {(r.review_id, r.review_comment_title, r.review_comment_message) for r in reviews.collect()}
    assert ("r1", None, 'two\nlines, "quoted"') in texts and len(texts) == 2


def test_quoted_line_breaks_on_split_edges(spark, tmp_path):
    rng = random.Random(4)
    words = ["plain", "5 inch", 'say ""hi""', "a,b", "\n", "\n\n", '""', "\nx,\"\"y\"\"\n", "", "é\n"]
    lines = ["id,text,note"]
    for i in range(600):
        quoted = "".join(rng.choices(words, k=rng.randrange(9)))
        lines.append(f'{i},"{quoted}",' + rng.choice(["", "NA", "end", '5" pipe', '"\n"', '"last, one"']))
        if i % 50 == 0:
            lines.append("")
    lines[300] = '299,"' + "long\nline," * 900 + '",x'  # goes on over several splits
    (tmp_path / "many.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "windows.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        for name in ("many.csv", "windows.csv"):
            path = str(tmp_path / name)
            one = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)  # one task
            expected = sorted(map(str, csv_files.nulls_from_tokens(one).collect()))
            assert sorted(map(str, csv_files.read_raw(spark, path, multiline=True).collect())) == expected
        assert len(expected) == 2
        assert spark.read.option("lineSep", "\n").text(str(tmp_path / "many.csv")).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_missing_file_is_skipped(spark, folder, capsys):
    assert csv_files.read_folder(spark, folder, "nowhere.csv") == {}
    assert "skipped" in capsys.readouterr().out


def test_rejected_casts_are_counted(spark, folder):
    raw = csv_files.read_raw(spark, f"{folder}/shop_orders_dataset.csv")
    found = {r.column_name: r.rejected for r in csv_files.cast_rejects(raw, ENTITIES["orders"].schema).collect()}
    assert found == {"order_purchase_timestamp": 0, "order_approved_at": 1}


def test_rejects_are_counted_while_writing(spark, folder, tmp_path):
    rejects = {}
    orders = csv_files.read_folder(spark, folder, "shop_orders_dataset.csv", rejects)["orders"]
    tables.replace_table(orders, str(tmp_path / "orders"))
    assert rejects["orders"].get == {"order_purchase_timestamp": 0, "order_approved_at": 1}


def test_whole_numbers_with_decimals(spark):
    raw = spark.createDataFrame([("2.0",), ("3",), ("x",), ("40.7",), ("NaN",)], "order_item_id string")
    typed = csv_files.cast_to(raw, ENTITIES["order_items"].schema)
    assert [r.order_item_id for r in typed.collect()] == [2, 3, None, None, None]
    assert csv_files.cast_rejects(raw, ENTITIES["order_items"].schema).first().rejected == 3


def test_no_file_is_lost(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "orders_2017.csv").write_text("order_id,customer_id,score\no1,c1,1\no2,c2,NA\n")
    (folder / "orders_2018.csv").write_text("order_id,customer_id,score\no3,c3,2.5\n")
    (folder / "campaigns.csv").write_text("name,spend\na,2.5\nb,NA\n")
    written = load_folder(spark, str(folder), str(tmp_path / "out"))
    assert set(written) == {"orders", "campaigns"}
    assert sorted(r.order_id for r in written["orders"].collect()) == ["o1", "o2", "o3"]
    assert dict(written["orders"].dtypes)["score"] == dict(written["campaigns"].dtypes)["spend"] == "double"


def test_centroids_follow_a_one_file_load(spark, folder, tmp_path):
    out = str(tmp_path / "warehouse")
    load_folder(spark, folder, out)
    with open(f"{folder}/shop_sellers_dataset.csv", "w", encoding="utf-8") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns9,77777,x,SP\n")
    written = load_folder(spark, folder, out, "shop_sellers_dataset.csv")
    assert "77777" in {r.geolocation_zip_code_prefix for r in written["geolocation_bis"].collect()}


def test_counts_kept_as_text(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,product_name_lenght,product_photos_qty\np1,40.0,2\np2,,many\n")
    products = csv_files.read_folder(spark, str(tmp_path))["products"]
    rows = sorted(tuple(r) for r in products.collect())
    assert rows == [("p1", "40", "2"), ("p2", None, "many")]
    report = check_tables({"products": products}).where("violations > 0")
    assert report.count() == 0


def test_load_job(spark, folder, tmp_path):
    rejects = {}
    written = load_folder(spark, folder, str(tmp_path / "warehouse"), rejects=rejects)
    assert rejects["orders"].get["order_approved_at"] == 1
    assert "customers" not in rejects  # nothing to cast
    assert [r.review_id for r in written["order_reviews"].collect()] == ["r1"]
    located = {r.geolocation_zip_code_prefix: r for r in written["geolocation_bis"].collect()}
    assert located["01037"].n == 2 and located["01037"].geopoint_location.x == pytest.approx(-46.7)
    assert located["09790"].n == 0 and located["09790"].geolocation_lat is None
    assert located["00999"].geopoint_location is None
    again = load_folder(spark, folder, str(tmp_path / "warehouse"))
    assert again["customers"].count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    assert tables.replace_table(df, str(tmp_path / "t")).count() == 2
    assert tables.append_table(df, str(tmp_path / "t")).count() == 4
    assert tables.replace_table(df, str(tmp_path / "t")).count() == 2
    tables.write_csv(df, str(tmp_path / "c"))
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "c"))
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1.5), ("b", None)]
    assert tables.empty_table(spark, ENTITIES["geolocation_bis"].schema).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert {tuple(r) for r in profile(df).collect()} == {("k", "string", 1), ("v", "int", 2)}


def test_only_values_of_the_right_form_are_cast_for_inference(spark, table, monkeypatch):
    numbers = ["1", " -2.5e3 ", "Infinity", "-inf", "NaN", "+.5", "0x1p3", "1d", "\t7", None]
    columns = {"number": numbers, "text": [*numbers[:-1], "x"], "whole": [" 1", "+2"] * 5, "long": ["1", "9" * 30] * 5, "truth": [" TRUE", "false "] * 5, "t": ["t", "f"] * 5}
    df = table(list(zip(*columns.values())), ", ".join(f"{c} string" for c in columns))
    asked = []
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *e: asked.extend(map(str, e)) or agg(self, *e))
    found = dict(csv_files.infer_types(df, df.columns).dtypes)
    assert found == {"number": "double", "text": "string", "whole": "bigint", "long": "double", "truth": "boolean", "t": "string"}
    casts = [e for e in asked if "TRY_CAST" in e.upper()]
    assert len(casts) == 18 and all("THEN TRY_CAST" in e.upper() for e in casts)  # a failing cast is a caught error, for each value
