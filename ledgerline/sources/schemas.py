"""Explicit schemas of the input files; nothing is inferred."""

from __future__ import annotations

TRAIN = "cust_id BIGINT, revenue_2018_2019 DOUBLE"
TEST = "cust_id BIGINT"
TRANSACTIONS = (
    "cust_id BIGINT, sale_id BIGINT, prod_id BIGINT, order_date TIMESTAMP, pack_date TIMESTAMP,"
    " sale_revenue DOUBLE, sale_discount_applied DOUBLE, returned_to_shop_id STRING,"
    " prod_size STRING, prod_brand STRING, prod_color STRING, prod_season STRING,"
    " prod_type_1 STRING, prod_type_3 STRING, prod_type_4 STRING, prod_type_5 STRING,"
    " prod_heel STRING, prod_material STRING, prod_print STRING, prod_clasp STRING,"
    " prod_comfort_sole STRING, prod_comfort_wear STRING, prod_web_only DOUBLE, prod_outlet DOUBLE"
)
FIGURES = (
    "id BIGINT, name STRING, link STRING, img_url STRING, category STRING, year INT,"
    " themes ARRAY<STRING>, img_local_path STRING"
)
ITEMS = (
    "appid BIGINT, name STRING, short_description STRING, about_the_game STRING,"
    " detailed_description STRING, release_date STRING, price DOUBLE, header_image STRING,"
    " windows INT, mac INT, linux INT, genres_json STRING, categories_json STRING,"
    " developers_json STRING, publishers_json STRING, tags_json STRING,"
    " positive BIGINT, negative BIGINT, recommendations BIGINT"
)
REVIEWS = (
    "appid BIGINT, review STRING, language STRING, weighted_vote_score STRING,"
    " votes_up BIGINT, voted_up INT"
)
NODES = "id STRING, label STRING"
EDGES = "source STRING, target STRING, action STRING"
NODE_METRICS = (
    "Id STRING, Label STRING, modularity_class INT, Eccentricity DOUBLE, closnesscentrality DOUBLE,"
    " harmonicclosnesscentrality DOUBLE, betweenesscentrality DOUBLE, `weighted indegree` DOUBLE,"
    " `weighted outdegree` DOUBLE, `Weighted Degree` DOUBLE, indegree INT, outdegree INT,"
    " Degree INT, eigencentrality DOUBLE, pageranks DOUBLE"
)
EDGE_WEIGHTS = (
    "Source STRING, Target STRING, Type STRING, Id BIGINT, Label STRING, Weight INT, action STRING"
)
