import os

from feria.sources.readers import read_csv


def test_reviews_csv_quoted_newlines_and_bom(spark, tmp_dir):
    p = os.path.join(tmp_dir, "reviews.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("review_id,order_id,review_score,review_comment_title,review_comment_message,"
                "review_creation_date,review_answer_timestamp\n")
        f.write('r1,o1,5,,"line one\nline two",2018-01-01 00:00:00,2018-01-02 00:00:00\n')
        f.write('r2,o2,1,"t","say ""hi""",2018-01-01 00:00:00,\n')
        f.write("r3,o3,3,,,2018-01-01 00:00:00,2018-01-02 00:00:00\n")
    df = read_csv(spark, p, "reviews")
    rows = {r.review_id: r for r in df.collect()}
    assert len(rows) == 3
    assert rows["r1"].review_comment_message == "line one\nline two"
    assert rows["r2"].review_comment_message == 'say "hi"'
    assert "review_id" in df.columns


def test_translation_csv_bom(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("product_category_name,product_category_name_english\ncama,bed\n")
    r = read_csv(spark, p, "category_translation").first()
    assert (r.product_category_name, r.product_category_name_english) == ("cama", "bed")


def test_refresh_from_raw_csv_files(spark, tmp_dir):
    """All nine raw CSV files -> cleaned tables -> star schema."""
    from feria.plans.refresh import refresh
    from feria.sources.readers import read_raw_dir
    raw_dir = os.path.join(tmp_dir, "raw")
    os.makedirs(raw_dir)
    files = {
        "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,"
                     "customer_state\nc1,u1,1001,São Paulo,sp\nc2,u1,1002, campinas ,SP\n",
        "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1001,Curitiba,PR\n",
        "products": "product_id,product_category_name,product_name_lenght,"
                    "product_description_lenght,product_photos_qty,product_weight_g,"
                    "product_length_cm,product_height_cm,product_width_cm\n"
                    "p1,cama,10,100,1,0,10,10,10\np2,cama,10,100,1,500,20,10,10\n"
                    "p3,,10,100,1,,,,\n",
        "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                  "order_delivered_carrier_date,order_delivered_customer_date,"
                  "order_estimated_delivery_date\n"
                  "o1,c1,delivered,2017-11-02 10:00:00,2017-11-02 11:00:00,2017-11-03 10:00:00,"
                  "2017-11-10 10:00:00,2017-11-20 00:00:00\n"
                  "o2,c2,canceled,2017-12-01 08:00:00,,,,2017-12-20 00:00:00\n",
        "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,"
                       "freight_value\no1,1,p1,s1,2017-11-05 00:00:00,100.50,10.00\n"
                       "o1,2,p2,s1,2017-11-05 00:00:00,50.00,0.00\n",
        "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                    "o1,1,credit_card,3,160.50\no2,1,boleto,1,0.00\n",
        "reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,"
                   "review_creation_date,review_answer_timestamp\n"
                   'r1,o1,5,,"muito bom\nchegou cedo",2017-11-11 00:00:00,2017-11-12 10:00:00\n'
                   "r2,o2,1,,,2017-12-21 00:00:00,\n",
        "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
                       "geolocation_city,geolocation_state\n1001,-23.5,-46.6,sao paulo,SP\n"
                       "1001,-23.6,-46.7,São Paulo,SP\n1002,-22.9,-47.0,campinas,SP\n"
                       "1002,40.0,-47.0,campinas,SP\n",
        "category_translation": "product_category_name,product_category_name_english\n"
                                "cama,bed_bath_table\n",
    }
    for name, text in files.items():
        with open(os.path.join(raw_dir, f"{name}.csv"), "w", encoding="utf-8-sig") as f:
            f.write(text)
    raw = read_raw_dir(spark, raw_dir)
    assert set(raw) == set(files)
    status = {r.table: r for r in refresh(spark, raw, os.path.join(tmp_dir, "out")).collect()}
    assert all(r.error is None for r in status.values()), status
    from feria.plans.publish import published
    star = os.path.join(tmp_dir, "out", "star")
    star = os.path.join(star, "runs", published(spark, star)["run"])
    cust = {r.customer_id: r for r in spark.read.parquet(f"{star}/dim_customers").collect()}
    assert cust["c1"].city == "sao paulo" and cust["c1"].state == "SP"
    assert cust["c2"].city == "campinas"
    prods = {r.product_id: r for r in spark.read.parquet(f"{star}/dim_products").collect()}
    assert prods["p1"].category_name_en == "bed_bath_table"
    assert float(prods["p1"].weight_g) == 500.0 and prods["p3"].category_name_pt == "unknown"
    geo = {r.zip_code_prefix: r for r in spark.read.parquet(f"{star}/dim_geolocation").collect()}
    assert float(geo[1001].lat) == -23.55 and float(geo[1002].lat) == -22.9
    assert spark.read.parquet(f"{star}/fact_payments").count() == 1
    o = {r.order_id: r for r in spark.read.parquet(f"{star}/fact_orders").collect()}
    assert (o["o1"].delivery_time_days, o["o1"].delay_days, o["o1"].order_yearmonth) == \
        (8, -10, "2017-11")
    assert o["o2"].has_items == 0
    rv = spark.read.parquet(f"{star}/fact_reviews").collect()
    assert {r.review_id: r.has_comment for r in rv} == {"r1": 1, "r2": 0}


SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_swapped_header_raises(spark, tmp_dir):
    import pytest
    p = os.path.join(tmp_dir, "s.csv")
    with open(p, "w") as f:
        f.write("seller_zip_code_prefix,seller_id,seller_city,seller_state\n1001,s1,Curitiba,PR\n")
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, p, "sellers")


def test_malformed_rows_are_rejects(spark, tmp_dir):
    from feria.sources.readers import read_csv_rejects, read_raw_rejects
    with open(os.path.join(tmp_dir, "sellers.csv"), "w") as f:
        f.write(SELLERS + "s1,1001,Curitiba,PR\ns2,abc,Natal,RN\ns3,1002,Belo,MG,extra\ns4,,Natal,RN\n")
    p = os.path.join(tmp_dir, "sellers.csv")
    assert sorted(r.seller_id for r in read_csv(spark, p, "sellers").collect()) == ["s1", "s4"]
    want = [("sellers", "s2,abc,Natal,RN"), ("sellers", "s3,1002,Belo,MG,extra")]
    assert sorted(map(tuple, read_csv_rejects(spark, p, "sellers").collect())) == want
    assert sorted(map(tuple, read_raw_rejects(spark, tmp_dir).collect())) == want
