"""Exports and loads of finished marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StringType

from martwright.schemas import DEFAULT_TEXT_WIDTH, MARTS, NATIONAL_TEXTS, TEXT_WIDTHS

# Fixed value: rows per insert batch.
BATCH_ROWS = 1000


def export_audit(df: DataFrame, root: str, table: str, run_date: date | str) -> str:
    """Dated Parquet copy: ``{root}/{table}/{yyyy-mm-dd}``. The same day is replaced."""
    path = f"{root}/{table}/{run_date}"
    df.write.mode("overwrite").parquet(path)
    return path


def publish(df: DataFrame, path: str) -> None:
    """Replace a whole table; loading the same data again changes nothing."""
    df.write.mode("overwrite").parquet(path)


def jdbc_column_types(mart: str) -> str:
    """Text widths of the target; other types follow from the schema."""
    texts = [f.name for f in MARTS[mart].fields if isinstance(f.dataType, StringType)]
    return ", ".join(f"{name} VARCHAR({TEXT_WIDTHS.get(name, DEFAULT_TEXT_WIDTH)})" for name in texts)


def serving_table(mart: str, schema: str = "marts") -> str:
    """The statement that makes a serving table, to be run once in the target: names and free text there take
    any script, which Spark's own column types can't ask for. Later loads empty the table and keep its types."""

    def kind(name: str, of: DataType) -> str:
        if isinstance(of, StringType):
            text = "NVARCHAR" if name in NATIONAL_TEXTS else "VARCHAR"
            return f"{text}({TEXT_WIDTHS.get(name, DEFAULT_TEXT_WIDTH)})"
        return {"boolean": "BIT", "int": "INT", "date": "DATE", "timestamp_ntz": "DATETIME2"}.get(
            of.simpleString(), of.simpleString().upper()
        )

    first, *others = [f"{f.name} {kind(f.name, f.dataType)}" for f in MARTS[mart].fields]
    return f"CREATE TABLE {schema}.{mart} ({', '.join([f'{first} PRIMARY KEY', *others])})"


def jdbc_options(mart: str, url: str, schema: str = "marts", connections: int = 8) -> dict[str, str]:
    """Options of a load that empties and refills ``schema.mart`` by ``connections`` tasks."""
    return {
        "url": url,
        "dbtable": f"{schema}.{mart}",
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(connections),
        "truncate": "true",
        "createTableColumnTypes": jdbc_column_types(mart),
    }


def load_jdbc(df: DataFrame, mart: str, url: str, properties: dict[str, str] | None = None, **placement) -> None:
    """Load a stamped mart into the serving database, in parallel, nothing collected."""
    options = jdbc_options(mart, url, **placement) | (properties or {})
    df.write.format("jdbc").options(**options).mode("overwrite").save()
