"""Reading change messages: envelope, filters, deltas, routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import names as N
from ..functions.dates import number

ENVELOPE = ("database", "table", "type", "data", "old", "ts")


def envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Split each message once into its envelope texts; ``data`` stays JSON text.

    ``json_tuple`` is a generator, so the filters above it read its output and
    the text is tokenized a single time, whatever number of branches follow.
    Malformed text gives a row of nulls, which every later filter drops.
    """
    return messages.select(F.json_tuple(value, *ENVELOPE).alias(*ENVELOPE))


def parse_once(df: DataFrame, parsed: Mapping[str, Column], *keep: str) -> DataFrame:
    """Columns ``keep`` plus parsed ones, each evaluated once per row.

    Going through a one-element array makes the parse part of a generator; filters
    on its fields then read the result. Written as plain columns, Spark would push
    such filters below the projection and parse the text again for every field tested.
    """
    packed = F.struct(*[c.alias(name) for name, c in parsed.items()])
    opened = df.select(*keep, F.explode(F.array(packed)).alias("_parsed"))
    return opened.select(*keep, *[F.col(f"_parsed.{name}") for name in parsed])


def mentions(table: str, value: str = "value") -> Column:
    """Text test that every message of ``table`` passes; cheap enough to run before parsing.

    A plain name can stand in JSON as itself or through unicode escapes, so texts with
    such escapes pass as well and are decided by the parsed envelope.
    """
    text = F.col(value)
    return text.contains(table) | text.contains("\\u")


def without_control(changes: DataFrame) -> DataFrame:
    """Drop the records that only mark the start and end of a bootstrap."""
    return changes.where(~F.col("type").isin(*N.CONTROL_KINDS))


def of_table(changes: DataFrame, table: str, kinds: Sequence[str] = (),
             database: str | None = None) -> DataFrame:
    """Keep one table's changes, optionally of given kinds and one database."""
    keep = F.col("table") == table
    if kinds:
        keep &= F.col("type").isin(*kinds)
    if database is not None:
        keep &= F.col("database") == database
    return changes.where(keep)


def bind(changes: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """Parse ``data`` with a schema known only now, lift its fields, keep ``extra``."""
    parsed = parse_once(changes, {"data": F.from_json("data", schema)}, *extra)
    return parsed.select("data.*", *extra)


def table_rows(messages: DataFrame, table: str, schema: T.StructType,
               kinds: Sequence[str] = (N.INSERT,), database: str | None = None) -> DataFrame:
    """Payload rows of one table straight from the raw messages."""
    candidates = envelope(messages.where(mentions(table)))
    rows = of_table(candidates, table, kinds, database).where(F.col("data").isNotNull())
    return bind(rows, schema)


def increases(changes: DataFrame, quantity: str, price: str) -> DataFrame:
    """Insert rows, plus updates that raise ``quantity``, as differences.

    Input: a ``data`` struct, ``old`` as a text map and ``type``. An update whose
    quantity grew counts only for the growth; its price becomes the price
    difference, or 0 when the old price is not part of the change. Numbers in
    ``old`` are text from outside, so a bad one makes the row fail the test
    instead of failing the job.
    """
    new_qty, old_qty = F.col(f"data.{quantity}"), number(F.col("old")[quantity])
    new_price, old_price = F.col(f"data.{price}"), F.col("old")[price]
    is_update = F.col("type") == N.UPDATE
    grew = is_update & (new_qty > old_qty)
    qty_type = changes.schema["data"].dataType[quantity].dataType
    return (changes
            .where((F.col("type") == N.INSERT) | F.coalesce(grew, F.lit(False)))
            .withColumn("data", F.col("data")
                        .withField(price, F.when(~is_update, new_price)
                                   .when(old_price.isNull(), F.lit(0.0))
                                   .otherwise(new_price - number(old_price)))
                        .withField(quantity, F.when(~is_update, new_qty)
                                   .otherwise((new_qty - old_qty).cast(qty_type)))))


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); a predicate that is null counts as false, so no row is lost."""
    sure = F.coalesce(valid, F.lit(False))
    return df.where(sure), df.where(~sure)


def configured_only(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Keep the changes whose table is listed in the configuration (left semi join)."""
    return changes.join(config, changes["table"] == config["source_table"], "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Newest row per key, by aggregation.

    ``max_by`` combines on the map side, so a key that holds a large share of the
    rows sends one row per task to the shuffle; a ranking window would bring all
    of them to one task. ``order_by`` must order the rows of a key totally.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.`{c}`") for c in rest]) \
        .select(*df.columns)
