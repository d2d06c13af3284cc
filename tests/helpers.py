from datetime import date, timedelta

from demandloom import Settings, schemas

P1, P2 = "product-1", "product-2"

CFG = Settings(
    execution_date=date(2024, 8, 8),
    time_delta=68,
    test_size=7,
    steps=9,
    window_size=7,
    metrics=("rmse", "mae"),
    selection_metric="mae",
)


def day(text: str) -> date:
    return date.fromisoformat(text)


def days(start: str, n: int) -> list[date]:
    return [day(start) + timedelta(days=i) for i in range(n)]


def inputs(spark, rows):
    return spark.createDataFrame(rows, schemas.INPUT)


def values(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def dense(start: str, n: int, city="B1", product=P1, value=lambda i: float(i + 1)):
    return [(city, product, d, value(i)) for i, d in enumerate(days(start, n))]
