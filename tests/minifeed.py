"""Two small feed days with everything that goes wrong in feeds, and what a summary of them must say."""

from __future__ import annotations

import zipfile
from pathlib import Path

from stopline.period import Period

PERIOD = Period.parse("2025-10-01", "2025-10-02")

# A tie, a stop without a row, rows without a stop, empty names, a renamed stop, a reordered header, a stop never visited.
DAYS = {
    "20251001": {
        "agency": "agency_id,agency_name\n1,Bolaget\n",
        "routes": "route_id,route_type\nr1,700\nr2,700\n",
        "stops": 'stop_id,stop_name\nA,Åre\nB,Borås\nC,\nE,""\n',
        "trips": "trip_id,route_id\nt1,r1\nt2,r1\nt3,r2\n",
        "stop_times": "trip_id,stop_id,stop_sequence\n"
        + "".join(f"t1,{stop},{i}\n" for i, stop in enumerate(["A", "A", "A", "B", "C", "X"])),
    },
    "20251002": {
        "agency": "agency_id,agency_name\n1,Bolaget\n",
        "routes": "route_id,route_type\nr1,700\nr3,700\n",
        "stops": "stop_name,stop_id\nÅre Station,A\nBorås,B\n,C\nNever visited,F\n",
        "trips": "trip_id,route_id\nt1,r1\nt4,r3\nt5,\n",
        "stop_times": "trip_id,stop_id,stop_sequence,pickup_type\n"
        + "".join(f"t1,{stop},{i},0\n" for i, stop in enumerate(["A", "B", "B", "C", "", "E"])),
    },
}

COUNTS = {"agency": 2, "routes": 4, "stops": 8, "trips": 6, "stop_times": 12}

TOP = [
    ("A", "Åre Station", 4, 2.0),
    ("B", "Borås", 3, 1.5),
    ("C", "Unknown", 2, 1.0),
    ("E", "Unknown", 1, 0.5),
    ("X", "Unknown", 1, 0.5),
    (None, "Unknown", 1, 0.5),
]

LEAST = [TOP[i] for i in (3, 4, 5, 2, 1, 0)]

ROUTES = {"r1": 3, "r2": 1, "r3": 1, None: 1}

REPORT = """\
GTFS Analytics Summary - 2025-10-18 09:55:00
==================================================

Analysis Period: 2025-10-01 to 2025-10-02
Number of days: 2

Dataset Summary:
- Agency records: 2
- Routes records: 4
- Stops records: 8
- Trips records: 6
- Stop times records: 12

Top 30 Most Visited Stops (Average per Day):
--------------------------------------------------
 1. Åre Station (2.0 avg visits/day)
 2. Borås (1.5 avg visits/day)
 3. Unknown (1.0 avg visits/day)
 4. Unknown (0.5 avg visits/day)
 5. Unknown (0.5 avg visits/day)
 6. Unknown (0.5 avg visits/day)

Top 30 Least Visited Stops (Average per Day):
--------------------------------------------------
 1. Unknown (0.5 avg visits/day)
 2. Unknown (0.5 avg visits/day)
 3. Unknown (0.5 avg visits/day)
 4. Unknown (1.0 avg visits/day)
 5. Borås (1.5 avg visits/day)
 6. Åre Station (2.0 avg visits/day)

Route Statistics:
------------------------------
- Total unique routes: 4
- Average trips per route: 1.5
"""


def write_directories(root: Path) -> str:
    for day, tables in DAYS.items():
        folder = root / f"sweden-{day}"
        folder.mkdir(parents=True)
        for name, text in tables.items():
            (folder / f"{name}.txt").write_text(text, encoding="utf-8")
    return str(root)


def write_archives(root: Path) -> str:
    root.mkdir(parents=True, exist_ok=True)
    for day, tables in DAYS.items():
        with zipfile.ZipFile(root / f"sweden-{day}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            for name, text in tables.items():
                archive.writestr(f"{name}.txt", text.encode("utf-8-sig" if name == "stops" else "utf-8"))
    return str(root)
