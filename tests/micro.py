"""The hand-worked micro-fixture of FIXTURES.md as Spark inputs."""

from pyspark.sql import SparkSession

from wishrank.sources.inputs import Inputs

WISHLIST = [
    ("U1", "G1", "C1"), ("U1", "G1", "C1"), ("U2", "G1", "C1"), ("U2", "G2", "C1"),
    ("U3", "G3", None), ("U4", "G9", "C9"), ("U5", "G9", None),
]
POPULARITY = [
    (50, "G1", "C1", "P1"), (40, "G2", "C1", "P1"), (30, "G3", "C2", "P1"),
    (20, "G4", "C3", "P2"), (10, "G5", "C1", "P1"),
]
PROMOTION = [("G2",), ("G2",), ("G4",)]
ORDER_ASSOC = [("G1", "G3", "9"), ("G1", "G4", "10"), ("G1", "G8", "99"), ("G1", None, "5")]
RULE_LOG = [("G1", "G3", "7"), ("G2", "G5", "3"), ("G9", "G1", "4")]


def micro_inputs(spark: SparkSession, wishlist=WISHLIST, popularity=POPULARITY, promotion=PROMOTION,
                 order_assoc=ORDER_ASSOC, rule_log=RULE_LOG) -> Inputs:
    return Inputs(
        wishlist=spark.createDataFrame(wishlist, "cust_no string, goods_code string, category_code string"),
        popularity=spark.createDataFrame(
            popularity, "count int, goods_code string, category_code string, p2_category_code string"
        ),
        promotion=spark.createDataFrame(promotion, "goods_code string"),
        order_assoc=spark.createDataFrame(order_assoc, "goods_code string, recomd_list string, node_importance string"),
        rule_log=spark.createDataFrame(rule_log, "icode string, rec_icode string, importance string"),
    )
