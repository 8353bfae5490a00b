"""Lists per key, and the row-per-item form of the same thing."""
from pyspark.sql import Window
from pyspark.sql import functions as F


def item_rows(df, keys, item, order):
    """One row per item: keys, position (from 0) by ``order``, item. The form for keys of any size."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select(*keys, (F.row_number().over(w) - 1).alias("position"), item.alias("item"))


def collect_items(df, keys, item, order, name="items"):
    """One row per key with the array of its items by ``order``; as long as the key has rows, so a key must fit
    in a row. Where it may not, ``item_rows`` holds the same items.
    """
    row = df.select(*keys, F.struct(F.struct(*order).alias("o"), item.alias("v")).alias("_item"))
    listed = row.groupBy(*keys).agg(F.sort_array(F.collect_list("_item")).alias("_list"))
    return listed.select(*keys, F.transform("_list", lambda x: x["v"]).alias(name))
