"""Parameter tables: short fixed lists that a report offers as choices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Metric name, slicer position.
SUMMARY_SLICER = [("Orders", 1), ("Tickets Sold", 2), ("Discount Given", 3), ("Profit", 4)]
SALES_SLICER = [
    ("Completed orders", 1),
    ("Tickets sold", 2),
    ("Sales revenue", 3),
    ("Discount", 4),
    ("Profit", 5),
]

# Lengths of the selectable periods.
DAY_PERIODS = [3, 7, 14, 30, 60]
MOVING_DAYS = [3, 7, 15, 24, 30]
MOVING_MONTHS = [3, 6, 9, 12]

# Label, metric, position, group.
SUMMARY_METRICS = [
    ("Total Orders", "total_orders", 2, 1),
    ("Completed", "complete_orders", 3, 1),
    ("Completion %", "completion_rate", 4, 1),
    ("Total Tickets", "tickets", 5, 2),
    ("Avg / Order", "avg_tickets_per_order", 6, 2),
    ("Avg Profit / Ticket", "avg_profit_per_ticket", 7, 2),
    ("Total Discount", "discount", 8, 3),
    ("Avg % / Order", "avg_discount_pct", 9, 3),
    ("Avg  Value / Order", "avg_discount_value_per_order", 10, 3),
    ("Total Profit", "profit", 11, 4),
    ("Margin %", "profit_margin", 12, 4),
    ("Avg / Order", "avg_profit_per_order", 13, 4),
]

# Label, metric, position, group, visible on its own.
SALES_METRICS = [
    ("Completed orders", "complete_orders", 1, 1, 1),
    ("vs PM %", "complete_orders_vs_pm", 2, 1, 0),
    ("Completion rate", "completion_rate", 3, 1, 0),
    ("Tickets sold", "tickets", 4, 2, 1),
    ("vs PM %", "tickets_vs_pm", 5, 2, 0),
    ("AVG / Order", "avg_tickets_per_order", 6, 2, 0),
    ("Sales revenue", "revenue", 7, 3, 1),
    ("vs PM %", "revenue_vs_pm", 8, 3, 0),
    ("AVG / Order", "avg_revenue_per_order", 9, 3, 0),
    ("Discount", "discount", 10, 4, 1),
    ("vs PM %", "discount_vs_pm", 11, 4, 0),
    ("AVG / Order", "avg_discount_value_per_order", 12, 4, 0),
    ("Profit", "profit", 13, 5, 1),
    ("vs PM %", "profit_vs_pm", 14, 5, 0),
    ("Margin %", "profit_margin", 15, 5, 0),
]

# Axis choices of the scatter chart.
SCATTER_AXES = [("Tickets", 0), ("Gross revenue", 1), ("Discount", 2), ("Profit", 3)]

# Colour modes of the scatter chart and the legend of each.
SCATTER_COLOURS = [("Default", 0), ("Margin %", 1), ("Order Value vs AVG", 2)]
SCATTER_LEGENDS = [
    (0, "Default", 0),
    (1, ">= 80%", 1),
    (1, "60% - 69%", 2),
    (1, "< 60%", 3),
    (2, ">= AVG", 4),
    (2, "< AVG", 5),
]


def summary_slicer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUMMARY_SLICER, "name string, slicer int")


def sales_slicer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SALES_SLICER, "name string, slicer int")


def summary_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SUMMARY_METRICS, "name string, metric string, position int, `group` int"
    )


def sales_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SALES_METRICS, "name string, metric string, position int, `group` int, visible int"
    )


def scatter_axes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCATTER_AXES, "name string, axis int")


def scatter_colours(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCATTER_COLOURS, "name string, cluster int")


def scatter_legends(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCATTER_LEGENDS, "cluster int, segment string, segment_id int")


def periods(spark: SparkSession, lengths: list[int], name: str = "days") -> DataFrame:
    return spark.createDataFrame([(n,) for n in lengths], f"{name} int")
