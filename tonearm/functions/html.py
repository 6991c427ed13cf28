"""Values from page text; whole pages, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonearm.functions.values import text_to_int

# --- fixed values: marks of the elements holding the play count -----------------------------
COUNT_CLASS = "encore-text-marginal"
COUNT_TEST_ID = "playcount"
# ------------------------------------------------------------------------------------------


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def play_count(html: Column | str, track_id: Column | str) -> Column:
    """Play count of a track from its page; NULL where the page shows none.

    It stands in a marked span inside the first link to the track itself, or else in the
    span with the test id.
    """
    html, track_id = _col(html), _col(track_id)
    link = F.concat(
        F.lit(r'(?s)<a\b[^>]*\bhref="\Q/track/'), track_id, F.lit(r'\E"[^>]*>(.*?)</a>')
    )
    inside = F.call_function("regexp_extract", html, link, F.lit(1))
    span = rf'<span\b[^>]*\bclass="(?:[^"]*\s)?{COUNT_CLASS}(?:\s[^"]*)?"[^>]*>([^<]*)</span>'
    by_class = text_to_int(F.trim(F.regexp_extract(inside, span, 1)))
    other = rf'<span\b[^>]*\bdata-testid="{COUNT_TEST_ID}"[^>]*>([^<]*)</span>'
    by_test_id = text_to_int(F.trim(F.regexp_extract(html, other, 1)))
    return F.coalesce(F.nullif(by_class, F.lit(0)), by_test_id)
