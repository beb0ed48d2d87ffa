"""Quote ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quoteflow import rules


def derived(job_id: Column, index: Column) -> Column:
    """Name-based (version 5) UUID of a job's index-th quote, 32 hex digits.

    The same job and position always give the same id, so a redelivered job rewrites its own rows.
    """
    name = F.concat(F.lit(rules.DERIVED_ID_PREFIX), job_id, F.lit(":"), index.cast("string"))
    digest = F.sha1(F.concat(F.unhex(F.lit(rules.URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant_digit = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 12),
        F.lit("5"),
        F.substring(digest, 14, 3),
        variant_digit,
        F.substring(digest, 18, 15),
    )


def fresh() -> Column:
    """Random id. Only for submission, where the row is written once and read back afterwards."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))
