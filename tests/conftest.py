import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from counterfoil.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "counterfoil-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


PRODUCTS = '''id,name,price,quantity_on_hand
1,"Chair, oak","$1,234.50",5
2,Desk,$89.995,12
3,"Lamp ""Luna""",19.99,abc
4,,$5.00,3
5,Shelf,$12.00,-4
6,Sofa,"$99,999.00",1
7,Stool,,
8,Bench,$40.00,0
'''
CUSTOMERS = '''Id,FirstName,LastName,city,state,ZIP,Address1,Address2,Email,Birthdate
1,Ann,Lee,Austin,TX,78701,1 Elm St,Unit 2,ann@example.com,2/3/1980
2,Bob,Ray,Boston,MA,02108,2 Oak St,,bob@example.com,02/03/1980
3,,Kim,Austin,TX,78701,,,,0000-00-00
4,Dee,Fox,Adjuntas,PR,601,4 Ash St,,,2/30/1990
5,Eve,Sun,,,,5 Fir St,,,
6,Ann,Lee,AUSTIN,TX,78701,6 Elm St,,,12/31/1999
'''
ORDERS = '''id,customerId,orderDate,dateShipped
10,1,2024-01-05 10:11:12,2024-01-07 00:00:00
11,1,2024-01-31 23:59:59,Cancelled
12,2,0000-00-00,
13,999,2024-02-01 00:00:00,2024-02-02 00:00:00
14,2,2024-02-01,2024-02-03 1:2:3
15,4,2024-02-10 08:00:00,
'''
ORDERLINES = '''orderId,productId,quantity
10,1,7
10,1,7
10,2,1
11,2,1
12,3,1
13,1,1
14,2,1
14,2,1
14,2,1
'''
TAXRATES = '''State,ZipCode,TaxRegionName,EstimatedCombinedRate,StateRate,EstimatedCountyRate,EstimatedCityRate,EstimatedSpecialRate,RiskLevel
TX,78701,AUSTIN,0.08250,0.06250,0,0.01000,0.01000,1
PR,601,ADJUNTAS,0.11500,0.10500,0,0.01000,0,1
'''


@pytest.fixture(scope="session")
def exports(tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    for name, text in {
        "products.csv": PRODUCTS,
        "customers.csv": CUSTOMERS,
        "orders.csv": ORDERS,
        "orderlines.csv": ORDERLINES,
        "TAXRATES.csv": TAXRATES,
        "sales_tax_rates.csv": "zip,rate\n501,0.08000\n",
    }.items():
        (folder / name).write_text(text)
    return str(folder)


@pytest.fixture(scope="session")
def shop(spark, exports):
    from counterfoil.plans.build import build_pos

    return build_pos(spark, exports)


@pytest.fixture(scope="session")
def priced_shop(shop):
    from counterfoil.plans.build import priced_and_taxed

    return priced_and_taxed(shop, scope="touched")


def rows(df, *order):
    """Rows as tuples, sorted by text so that NULLs are no trouble."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
