"""Small hand-made and random histories."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from snaptrail.layout import CATEGORY_MAP_SCHEMA, HISTORY_SCHEMA

DAY_1 = datetime(2024, 1, 1, 6)
SAME = object()


def day(number: int) -> datetime:
    return DAY_1 + timedelta(days=number - 1)


def history(spark, rows, schema: str = HISTORY_SCHEMA):
    """Rows of (run day, workspace id or None, setting, value[, overrides])."""
    return spark.createDataFrame([record(*row) for row in rows], schema)


def record(run, workspace, name, value, overrides=None):
    values = {
        "collected_at": day(run),
        "account_id": "acct",
        "scope": "account" if workspace is None else "workspace",
        "workspace_id": workspace,
        "workspace_name": None if workspace is None else f"ws-{workspace}",
        "setting_name": name,
        "setting_value": value,
        "setting_type": "StringSetting",
        "source": "test",
        "category": None,
        "preview_phase": None,
        "description": None,
    }
    values.update(overrides or {})
    return tuple(values.values())


def category_map(spark, rows):
    """Rows of (setting, category, label set, day)."""
    return spark.createDataFrame([(n, c, v, day(d)) for n, c, v, d in rows], CATEGORY_MAP_SCHEMA)


def random_rows(seed: int, settings=12, runs=10):
    """Series with gaps, repeated observations, NULLs, sentinels and renamed workspaces."""
    draw = random.Random(seed)
    values = ["true", "True", "false", "x", None, "<unavailable>", "<null>", "<not-set>"]
    rows = []
    for name in range(settings):
        for workspace in (None, 0, 1, 2, 3):
            for run in range(1, runs + 1):
                if draw.random() < 0.35:
                    continue
                for _ in range(2 if draw.random() < 0.15 else 1):
                    renamed = {"workspace_name": "renamed"} if draw.random() < 0.2 else None
                    rows.append((run, workspace, f"s{name}", draw.choice(values), renamed))
    return rows
