"""Dataset catalogue (S3): name, raw path, target, drop list, cleaner."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import clean as C


@dataclass(frozen=True)
class DatasetSpec:
    index: int
    name: str
    raw_path: str
    target: str
    drop: tuple[str, ...] = ()
    cleaner: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)


# The four study tables (targets, drop lists, display names)
RETAIL_DROP = ("Row ID", "Order ID", "Order Date", "Ship Date", "Customer ID",
               "Customer Name", "Product ID", "Product Name", "Country", "Postal Code")


def default_catalog(root: str) -> list[DatasetSpec]:
    r = root.rstrip("/")
    return [
        DatasetSpec(0, "Superstore (Profit)", f"{r}/data1/superstore.csv", "Profit",
                    RETAIL_DROP, C.clean_retail),
        DatasetSpec(1, "Flight Price", f"{r}/data2/flight_price.csv", "price", (), C.clean_flight),
        DatasetSpec(2, "Used Car Price", f"{r}/data3/used_car.csv", "price", (), C.clean_used_car),
        DatasetSpec(3, "Obesity (Weight)", f"{r}/data4/obesity.csv", "Weight", (), C.clean_obesity),
    ]
