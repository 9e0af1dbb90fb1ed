"""Dictionary lookups: the dictionary is read anew for each batch and stays on one side of the join."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookhouse.operators.sizing import small_join


def dictionary_rows(snapshot: DataFrame, key: str = "rowkey", name: str = "dic_name") -> DataFrame:
    """Keyed dictionary with its name nested in one column family."""
    return snapshot.select(F.col(key).alias("rowkey"), F.struct(F.col(name).alias("dic_name")).alias("info"))


def look_up(rows: DataFrame, code: str, dictionary: DataFrame, name: str, how: str) -> DataFrame:
    """Add the dictionary name of `code` as column `name`; `how` is inner or left."""
    side = dictionary.select(F.col("rowkey").alias("_code"), F.col("info.dic_name").alias(name))
    return small_join(rows.withColumn("_code", F.col(code)), side, ["_code"], how).drop("_code")


def comment_facts(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their rating; a comment with an unknown rating is dropped."""
    return look_up(comments, "appraise", dictionary, "appraise_name", "inner").select(
        "id", "user_id", "nick_name", "sku_id", "spu_id", "order_id", F.col("appraise").alias("appraise_code"),
        "appraise_name", "comment_txt", "create_time", "operate_time",
    )


def payment_facts(paid_lines: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid order lines with the name of the payment type, NULL if unknown."""
    return look_up(paid_lines, "payment_type", dictionary, "payment_type_name", "left").select(
        "id", "order_id", "user_id", F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        "payment_time", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "sku_name",
        "order_price", "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount", "ts",
    )


def comments_with_relational_dictionary(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The same comment fact from a dictionary table (dic_code, dic_name, parent_code)."""
    return comment_facts(comments, dictionary_rows(dictionary, "dic_code"))
