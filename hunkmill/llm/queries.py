"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hunkmill.llm import caps, encoding, leaks, looks, neardup, pairs, splits


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": splits.p1_found,
        "p1_forest": splits.p1_forest,
        "p1_splits": splits.p1_splits,
        "p2_found": caps.p2_found,
        "p3_found": pairs.p3_found,
        "p3_flags": pairs.p3_flags,
        "p4_found": neardup.p4_found,
        "p4_groups": neardup.p4_groups,
        "p6_ids": encoding.p6_ids,
        "p7_found": leaks.p7_found,
        "p7_items": leaks.p7_items,
        "p7_clean": leaks.p7_clean,
        "p7_verbatim": leaks.p7_verbatim,
        "p8_found": looks.p8_found,
        "p8_form": looks.p8_form,
        "p8_groups": looks.p8_groups,
    }


def oracle_sql() -> dict[str, str]:
    return {"p1_found": splits.P1_SQL, "p1_splits": splits.P1_SPLITS_SQL, "p2_found": caps.P2_SQL, "p4_found": neardup.P4_SQL, "p7_verbatim": leaks.VERBATIM_SQL} | looks.oracle_sql()
