"""Text, key and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column reference that also works for names with a dot, such as ``S.No``."""
    return "`" + name.replace("`", "``") + "`"


def normalise_country(country: Column) -> Column:
    """Dots removed, lower case, first character upper case: ``U.S.A.`` gives ``Usa``."""
    plain = F.lower(F.replace(country, F.lit("."), F.lit("")))
    return F.concat(F.upper(F.left(plain, F.lit(1))), F.substr(plain, F.lit(2)))


def order_key(market: Column, bill_to: Column, order: Column, sep: str = "") -> Column:
    """Market group (as int), bill-to code and order number in one text; null if any part is null."""
    parts = [market.try_cast("int").cast("string"), bill_to.cast("string"), order.cast("string")]
    if sep:
        return F.when(parts[0].isNotNull() & bill_to.isNotNull() & order.isNotNull(), F.concat_ws(sep, *parts))
    return F.concat(*parts)


def list_items(text: Column) -> Column:
    """Comma list as an array of trimmed entries."""
    return F.transform(F.split(text, ","), lambda entry: F.trim(entry))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def upload_type(path: Column) -> Column:
    """Upload class of a published file, read from the partition folder in its path."""
    return (
        F.when(path.contains("file_type=retraining"), "Retraining")
        .when(path.contains("file_type=testing"), "Testing")
        .otherwise("Training")
    )
