"""Found spans: rows of kind, start and stop in code points of the source text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"
FOUND = f"struct<base:{SPANS},spans:{SPANS}>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
_FOUND = pa.struct([("base", pa.list_(_SPAN)), ("spans", pa.list_(_SPAN))])

Span = tuple[str, int, int]


def ordered(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def finder_udf(find):
    """Column function text → FOUND from ``find(text) -> (base spans, all spans)``."""

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": k, "start": a, "stop": b} for k, a, b in spans]

    @arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            base, spans = find(text.as_py() or "")
            out.append({"base": rows(base), "spans": rows(spans)})
        return pa.array(out, _FOUND)

    return found


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
