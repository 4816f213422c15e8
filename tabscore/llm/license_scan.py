"""License scan: ordered signature rules behind a keyword prefilter.

A text is cut into words (A-Z lower-cased; runs of digits, letters and all characters above ASCII).  A rule's regex runs over the words joined by
one space, and only if the text holds the rule's keyword.  Overlaps are resolved by priority: a detection that lies within
an accepted one of higher priority, or within a longer one of the same priority, is suppressed.

Defined results: a null or empty text has no words and no detection; repeated rows give repeated rows; columns of
the input with a clashing name are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscore.llm.common import read
from tabscore.llm.license_rules import BASE, rules

DETECTION = "array<struct<label:string,priority:int,start_word:long,n_words:long>>"
ADDED = (f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
         f"detections {DETECTION}")

#: Bytes to words: ASCII letters and digits stay (A-Z lower-cased), bytes of other characters stay, the rest parts words.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(TABLE).split(b" ")


def border(regex: str):
    return re.compile(b"(?<![^ ])(?:" + regex.encode() + b")(?![^ ])")


@lru_cache(maxsize=1)
def compiled():
    """Rules by keyword, and the base phrases."""
    by: dict[bytes, list] = {}
    for label, priority, keyword, regex in rules():
        by.setdefault(keyword.encode(), []).append((label, priority, border(regex)))
    return by, [(p.encode(), label, border(p)) for p, label in BASE]


def suppress(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """``(priority, start, end, label)``: drop what lies within an accepted interval."""
    out, starts, ends = [], [], []
    for level in sorted({x[0] for x in found}, reverse=True):
        kept, far = [], -1
        for x in sorted({x for x in found if x[0] == level}, key=lambda x: (x[1], -x[2], x[3])):
            at = bisect.bisect_right(starts, x[1]) - 1
            inside = at >= 0 and ends[at] >= x[2]
            same = kept and (x[1], x[2]) == kept[-1][1:3]
            if not inside and (x[2] > far or same):
                kept.append(x)
                far = max(far, x[2])
        out += kept
        spans = sorted((x[1], x[2]) for x in out)
        starts, ends, top = [s for s, _ in spans], [], -1
        for _, e in spans:
            top = max(top, e)
            ends.append(top)
    return sorted(out, key=lambda x: (x[1], x[2], x[3]))


def scan_text(text: str | None) -> tuple:
    """n_words, n_base, first, last, base labels, labels, score, detections of one text."""
    words = [w for w in words_of(text or "") if w]
    flat = b" ".join(words)
    by, base = compiled()
    places, base_labels = [], set()
    for phrase, label, regex in base:
        if phrase in flat:
            hits = [m.start() for m in regex.finditer(flat)]
            places += hits
            if hits:
                base_labels.add(label)
    found = []
    for keyword, group in by.items():
        if keyword in flat:
            for label, priority, regex in group:
                found += [(priority, m.start(), m.end(), label) for m in regex.finditer(flat)]
    kept = suppress(found)
    if not places and not kept:
        return len(words), 0, None, None, "", "", 0.0, []
    at = [0]  # byte at which each word starts
    for w in words:
        at.append(at[-1] + len(w) + 1)
    spot = {p: bisect.bisect_left(at, p) for p in places}
    labels = base_labels | {x[3] for x in kept}
    detections = [{"label": x[3], "priority": x[0], "start_word": (s := bisect.bisect_left(at, x[1])),
                   "n_words": bisect.bisect_left(at, x[2]) - s} for x in kept]
    return (len(words), len(places), min(spot.values(), default=None), max(spot.values(), default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), max([x[0] for x in kept], default=60) / 100, detections)


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows with the scan's columns added; one narrow pass, no shuffle.  ``score`` is the best accepted priority as
    a fraction of 1, 0 where nothing was found."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    shape = T.StructType.fromDDL(ADDED)
    rest = [f for f in df.schema.fields if f.name not in shape.names]
    kinds = [to_arrow_type(f.dataType) for f in shape.fields]

    def run(batches):
        for batch in batches:
            rows = [scan_text(x) for x in batch.column(text).to_pylist()]
            made = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            if rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*[f.name for f in rest], *shape.names])

    return df.select(*[F.col(f"`{f.name}`") for f in rest]).mapInArrow(run, T.StructType(rest + shape.fields))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: doc_id, words, base places and labels, labels, score, detections."""
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


QUERIES = {"op4_license_scan": op4_license_scan}
