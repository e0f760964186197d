"""Small raw files."""

from __future__ import annotations

import os

SF_SMALL = "/root/testdata/sf0.001"

COLUMNS = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "fare_amount",
    "trip_distance",
    "passenger_count",
    "total_amount",
]


def clean_line(i: int = 0, day: str = "2019-01-01") -> list[str]:
    return [f"{day} 10:00:00", f"{day} 10:30:00", str(10.0 + i), str(1.5 + i), "1", str(12.0 + i)]


def bad_line(day: str = "2019-01-01") -> list[str]:
    return [f"{day} 10:00:00", f"{day} 10:30:00", "-1.0", "1.5", "1", "0.0"]


def sample(n_clean: int, n_bad: int, day: str = "2019-01-01") -> list[list[str]]:
    return [clean_line(i, day) for i in range(n_clean)] + [bad_line(day)] * n_bad


def write_csv(folder: str, name: str, lines: list[list[str]], columns=COLUMNS, order=None) -> str:
    """One headered file; ``order`` permutes the columns."""
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        for line in [list(columns), *lines]:
            out.write(",".join(line if order is None else [line[i] for i in order]) + "\n")
    return path
