"""SQL statements of the text rules, written on their own for the value checks."""

SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def collapse(text: str) -> str:
    return f"regexp_replace({text}, '{SPACE}+', ' ', 'g')"


def clean(text: str) -> str:
    """Cleaned for chunking."""
    return rf"trim(regexp_replace({collapse(text)}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'))"


def extracted(text: str) -> str:
    return f"trim({collapse(text)})"


def not_blank(text: str) -> str:
    return rf"regexp_matches(coalesce({text}, ''), '[^\s\x0B\x1C-\x1F\x85\p{{Z}}]')"


def cut(piece: str) -> str:
    """Kept length of a piece of at least 100 characters."""
    sentence = rf"length(regexp_extract(right({piece}, 100), '(?s)^(.*[.!?\n])', 1))"
    word = f"length(regexp_extract(right({piece}, 50), '(?s)^(.*) ', 1))"
    return f"""CASE WHEN {sentence} > 0 THEN length({piece}) - least(length({piece}), 100) + {sentence}
      WHEN instr(right({piece}, 50), ' ') > 0 AND length({piece}) - least(length({piece}), 50) + {word} > 0
        THEN length({piece}) - least(length({piece}), 50) + {word}
      ELSE length({piece}) END"""


def boundary_chunks(source: str, window: int = 1000, overlap: int = 200) -> str:
    """CTEs ending in `chunks(id, chunkIndex, startPosition, endPosition, chunkText, totalChunks)`.

    `source` is a query giving id and text. Needs WITH RECURSIVE.
    """
    return f"""texts AS (SELECT id, {clean('text')} AS t FROM ({source}) WHERE {not_blank('text')}),
  sized AS (SELECT id, t, length(t) AS n FROM texts),
  walk AS (
    SELECT id, t, n, 0 AS i, 0 AS s,
      CASE WHEN n <= {window} THEN n ELSE {cut(f"left(t, {window})")} END AS e
    FROM sized
    UNION ALL
    SELECT id, t, n, i + 1, p, CASE WHEN p + {window} >= n THEN n ELSE p + {cut(f"substring(t, p + 1, {window})")} END
    FROM (SELECT id, t, n, i, CASE WHEN e - {overlap} <= s THEN e ELSE e - {overlap} END AS p FROM walk WHERE n > {window})
    WHERE p < n),
  chunks AS (
    SELECT id, CAST(i AS INTEGER) AS chunkIndex, CAST(s AS INTEGER) AS startPosition, CAST(e AS INTEGER) AS endPosition,
      substring(t, s + 1, e - s) AS chunkText, CAST(count(*) OVER (PARTITION BY id) AS INTEGER) AS totalChunks
    FROM walk)"""


def simple_chunks(source: str, window: int = 1000, overlap: int = 200) -> str:
    """As `boundary_chunks`, at fixed steps."""
    step = window - overlap
    return f"""texts AS (SELECT id, {clean('text')} AS t FROM ({source}) WHERE {not_blank('text')}),
  sized AS (SELECT id, t, length(t) AS n FROM texts),
  starts AS (
    SELECT id, t, n, unnest(CASE WHEN n <= {window} THEN [0] ELSE generate_series(0, n - 1, {step}) END) AS s FROM sized),
  chunks AS (
    SELECT id, CAST(s // {step} AS INTEGER) AS chunkIndex, CAST(s AS INTEGER) AS startPosition,
      CAST(least(s + {window}, n) AS INTEGER) AS endPosition, substring(t, s + 1, {window}) AS chunkText,
      CAST(count(*) OVER (PARTITION BY id) AS INTEGER) AS totalChunks
    FROM starts)"""


def tried(source: str, name: str = "tried") -> str:
    """CTEs ending in `name`: rows of `source`("offset", id, modifiedTime, ok, ...) that are worth an attempt."""
    return f"""{name}_ep AS (
    SELECT *, coalesce(sum(CASE WHEN ok AND modifiedTime IS NULL THEN 1 ELSE 0 END) OVER (
      PARTITION BY id ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch
    FROM ({source})),
  {name}_seen AS (
    SELECT *, max(CASE WHEN ok THEN modifiedTime END) OVER (
      PARTITION BY id, epoch ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
    FROM {name}_ep),
  {name} AS (SELECT * FROM {name}_seen WHERE modifiedTime IS NULL OR seen IS NULL OR modifiedTime > seen)"""
