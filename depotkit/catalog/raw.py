"""Raw CSV scans of files that Spark writes from the given tables, with line breaks inside quotes."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from depotkit.catalog.registry import query
from depotkit.session import shared_folder
from depotkit.sources import readers

_NOTE = """case p_partkey % 5 when 0 then concat(p_name, chr(10), 'made by "', p_brand, '"', chr(10)) when 1 then concat('say "', p_brand, '", ok')
    when 2 then p_name when 3 then concat(chr(10), p_type) else null end"""
_PARTS = f"select p_partkey as product_id, p_name as sku, {_NOTE} as note from {{part}}"


def _scan(t):
    """Writes the parts as CSV, every eleventh with a field too many, a header in each file, and scans it."""
    quoted = lambda c: F.when(F.col(c).rlike('[",\\n]'), F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit("")))
    line = F.concat_ws(",", F.col("product_id").cast("string"), quoted("sku"), quoted("note"), F.when(F.col("product_id") % 11 == 0, "extra"))
    lines = t.spark.sql(_PARTS, part=t.part).select(line.alias("value"))

    def headed(batches):
        for i, batch in enumerate(batches):
            if i == 0:
                yield pa.RecordBatch.from_arrays([pa.array(["product_id,sku,note"])], schema=batch.schema)
            yield batch

    folder = f"{shared_folder(t.spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
    lines.mapInArrow(headed, "value string").write.text(f"{folder}/products.csv")
    return readers.scan_raw(t.spark, "products", folder)


@query("s_raw_rows", "product_id sku note",
       f"select cast(product_id as varchar) as product_id, sku, note from ({_PARTS}) x where product_id % 11 <> 0")
def s_raw_rows(t):
    return _scan(t).rows


@query("s_raw_rejected", "reason i:records i:characters",
       f"""select 'surplus fields' as reason, count(*) as records, sum(length(cast(product_id as varchar)) + length(sku) + 8 + coalesce(length(note), 0)
         + case when note like '%"%' or note like '%' || chr(10) || '%' then 2 + length(note) - length(replace(note, '"', '')) else 0 end) as characters
         from ({_PARTS}) x where product_id % 11 = 0 having count(*) > 0""")
def s_raw_rejected(t):
    found = _scan(t).rejected.groupBy(F.col("_reason").alias("reason"))
    return found.agg(F.count("*").alias("records"), F.sum(F.length("_record")).alias("characters"))
