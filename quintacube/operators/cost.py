"""Average purchase cost per product and profit per sale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quintacube.functions.expressions import line_profit, line_value
from quintacube.functions.sizing import small_side

# Twelve decimals in, sixteen out: `avg` on decimal(12,2) itself would keep only six.
_AVERAGE_INPUT = "decimal(22,12)"
COST_TYPE = "decimal(20,8)"


def average_cost(stg_purchases: DataFrame, cost_type: str = COST_TYPE) -> DataFrame:
    """Unweighted all-time average of the purchase price, computed once per product."""
    price = F.col("tb012_017_valor_unitario").cast(_AVERAGE_INPUT)
    return stg_purchases.groupBy("tb012_cod_produto").agg(
        F.avg(price).cast(cost_type).alias("custo_medio")
    )


def profit_per_sale(stg_sales: DataFrame, cost: DataFrame) -> DataFrame:
    """Each sale with its value and profit at full scale.

    The costs are written once: small ones are broadcast, and beyond that a product with very many
    sales is split, which a join onto the aggregation itself would not allow.
    """
    price, quantity = F.col("tb010_012_valor_unitario"), F.col("tb010_012_quantidade")
    return stg_sales.join(small_side(cost), "tb012_cod_produto", "left").select(
        *stg_sales.columns,
        line_value(price, quantity).alias("valor"),
        line_profit(price, F.col("custo_medio"), quantity).alias("lucro"),
    )
