import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "ledgerline-tests", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


ITEMS = """
21  4 510 2016-03-10  40.00   0.00 37 Nike  red   W15 women wedge suede
21  4 511 2016-03-10  60.00 -15.00 37 Gabor black S16 women flat  leather
21  9 512 2017-11-05  30.00 -10.00 43 Other blue  W17 men   flat  canvas
22  5 513 2017-02-01  54.00   0.00 29 Other green S16 boys  flat  canvas
22  6 514 2017-03-13  46.00  -4.00 30 Other green S16 boys  flat  rubber
23  7 515 2016-06-21 210.50   0.00 40 Gabor black W16 women heel  leather
24  8 510 2017-08-02  75.25  -0.75 39 Nike  red   S17 girls flat  suede
24 10 516 2017-12-24  19.90   0.00 38 Nike  white W17 girls wedge suede
25 11 517 2016-01-30  88.00   0.00 44 Other brown W15 men   flat  leather
31 12 511 2017-05-05  61.00   0.00 36 Gabor black S16 women heel  leather
32 13 518 2016-10-17  33.30  -3.30 28 Nike  blue  W16 boys  flat  canvas
"""


@pytest.fixture(scope="session")
def shop(spark):
    """Five training and two test customers; nobody has more than two orders."""
    import datetime as dt

    train = spark.createDataFrame([(21, 0.0), (22, 310.5), (23, 0.0), (24, 42.0), (25, 0.0)], "cust_id bigint, revenue_2018_2019 double")
    test = spark.createDataFrame([(31,), (32,)], "cust_id bigint")
    rows = []
    for line in ITEMS.split("\n")[1:-1]:
        cust, sale, prod, day, revenue, discount, size, brand, color, season, kind, heel, material = line.split()
        day = dt.datetime.fromisoformat(day)
        rows.append(
            (int(cust), int(sale), int(prod), day, day + dt.timedelta(days=2), float(revenue), float(discount), None, size, brand, color, season, kind, heel, material, None, "cork", 1.0, 0.25)
        )
    tx = spark.createDataFrame(
        rows,
        "cust_id bigint, sale_id bigint, prod_id bigint, order_date timestamp, pack_date timestamp, sale_revenue double,"
        " sale_discount_applied double, returned_to_shop_id string, prod_size string, prod_brand string, prod_color string,"
        " prod_season string, prod_type_1 string, prod_heel string, prod_material string, prod_clasp string,"
        " prod_comfort_sole string, prod_web_only double, prod_outlet double",
    )
    return train, test, tx
