"""Column -> Column text helpers (all JVM-side except the NFKD step of ``clean_text``).

Regex dialect notes.  The rules below come from Python ``re`` patterns.  Java
regexes differ in two places that matter here:

* ``.`` and ``$`` in Java treat ``\\r``, ``\\u0085``, ``\\u2028``... as line ends;
  Python only ``\\n``.  The ``(?d)`` (UNIX_LINES) flag gives Python's behaviour.
* ``\\s`` / ``\\w`` are ASCII in Java and Unicode in Python; ``(?U)`` fixes that.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.batches import parts

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference rule for identical keys and text).
# URL normalisation rewrites, applied in this order, then lower-case, then strip:
#   [?&](utm_[^&]+|fbclid|gclid|mc_[^&]+)=[^&]*   ->  ''
#   [?&]sid=[^&]*                                  ->  ''
#   /#.*$                                          ->  ''
#   ^http://                                       ->  'https://'
#   ^https://www\.                                 ->  'https://'
#   /\?$                                           ->  ''
#   /$                                             ->  ''
#   \?$                                            ->  ''
URL_REWRITES = [
    (r"[?&](utm_[^&]+|fbclid|gclid|mc_[^&]+)=[^&]*", ""),
    (r"[?&]sid=[^&]*", ""),
    (r"/#.*$", ""),
    (r"^http://", "https://"),
    (r"^https://www\.", "https://"),
    (r"/\?$", ""),
    (r"/$", ""),
    (r"\?$", ""),
]
# ANSI escape sequences removed before text clean-up.
ANSI_ESCAPE = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"
# Link pattern left out of a post's length.
LINK = r"https?://\S+"
# Post length limit (characters, links excluded) and tagline limits.
POST_MAX = 257
TAGLINE_MAX, TAGLINE_KEEP, TAGLINE_ELLIPSIS = 280, 277, "..."
BODY_LIMIT, PROMPT_BODY_LIMIT = 2000, 1500
EMPTY_FALLBACK = "[Error: No summary generated]"
# ---------------------------------------------------------------------------

# Python's str.strip()/isspace() whitespace (Unicode White_Space plus \x1c-\x1f),
# as characters, from Python's own rule, for btrim (which touches only the ends).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_url(c) -> Column:
    """P1. Normal form of a URL used as a dedup / ledger key.

    Null stays null and '' stays '' (the reference returns falsy input as is).
    Kept quirks: ``?utm_x=1&a=2`` becomes ``&a=2``; the ``http://`` upgrade is
    case-sensitive and runs before lower-casing; whitespace is stripped last.
    """
    x = _col(c)
    for pattern, repl in URL_REWRITES:
        x = F.regexp_replace(x, "(?d)" + pattern, repl)
    return strip_ws(F.lower(x))


def strip_ws(c) -> Column:
    """P19. Python ``str.strip()``: Unicode whitespace at both ends (Spark ``trim``
    strips spaces only).  ``btrim`` with the character set looks at the two ends
    only, where a regex would scan the whole text."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


@F.arrow_udf(T.StringType())
def _nfkd_ascii(s: pa.Array) -> pa.Array:
    """NFKD, then drop every non-ASCII code point.  Arrow-batched, and only a part of a batch is
    ever there as Python strings; Spark has no NFKD."""
    def one(v):
        if v is None or v.isascii():
            return v
        return unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")
    done = [pa.array([one(v) for v in s.slice(lo, hi - lo).to_pylist()], pa.string()) for lo, hi in parts(s)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def clean_text(c) -> Column:
    """P2. Remove ANSI escapes; NFKD; keep ASCII; delete control characters
    (newlines too, so words on adjacent lines join); ``"`` -> ``'``; strip;
    collapse whitespace.  Null -> ''.
    """
    x = F.regexp_replace(_col(c), ANSI_ESCAPE, "")
    x = _nfkd_ascii(x)
    x = F.regexp_replace(x, r"[\x00-\x1F\x7F]", "")
    x = F.replace(x, F.lit('"'), F.lit("'"))
    # Only ASCII without control characters is left, so whitespace is ' '.
    x = F.regexp_replace(F.trim(x), " +", " ")
    return F.coalesce(x, F.lit(""))


def slug(c) -> Column:
    """P4. Folder slug: every non-word character -> '_', runs collapsed, '_' stripped.

    Python's Unicode ``\\w`` is letters, numbers and '_', i.e. ``[\\p{L}\\p{N}_]``
    (Java's ``(?U)\\w`` would also take combining marks)."""
    # "each non-word character -> '_', then runs of '_' -> one '_'" is the same as
    # "each run of characters that are not letters or numbers -> '_'" (two passes).
    x = F.regexp_replace(_col(c), r"[^\p{L}\p{N}]+", "_")
    return F.regexp_replace(x, "^_|_$", "")


def folder_from_file_name(c, prefix: str, suffix: str = ".csv") -> Column:
    """P5. Folder name from ``<prefix><folder><suffix>``; any other name raises."""
    import re as _re
    pat = "^" + _re.escape(prefix) + "(.*)" + _re.escape(suffix) + "$"
    x = _col(c)
    return F.when(x.rlike("(?s)" + pat), F.regexp_extract(x, "(?s)" + pat, 1)).otherwise(
        F.raise_error(F.concat(F.lit(f"file name must look like '{prefix}<folder>{suffix}': "),
                               F.coalesce(x, F.lit("null")))).cast("string"))


def url_key(c) -> Column:
    """P6. Cache key: md5 hex of the raw URL (not its normal form)."""
    return F.md5(_col(c))


def cut(c, limit: int = TAGLINE_MAX, keep: int = TAGLINE_KEEP, ellipsis: str = TAGLINE_ELLIPSIS) -> Column:
    """P10. Longer than ``limit`` characters -> first ``keep`` characters + ellipsis."""
    x = _col(c)
    return F.when(F.char_length(x) > limit, F.concat(F.substring(x, 1, keep), F.lit(ellipsis))).otherwise(x)


def limit_chars(c, n: int) -> Column:
    """P11 / P21. First ``n`` characters (code points)."""
    return F.substring(_col(c), 1, n)


def empty_fallback(c, fallback: str = EMPTY_FALLBACK) -> Column:
    """P15. Null, empty or whitespace-only text -> the fallback text."""
    x = _col(c)
    return F.when(x.isNull() | (F.regexp_replace(x, r"(?U)\s", "") == ""), F.lit(fallback)).otherwise(x)


def char_count(c) -> Column:
    """P16. Length in code points."""
    return F.char_length(_col(c))


def link_free_length(c) -> Column:
    """P17. Length after removing ``https?://\\S+`` links."""
    return F.char_length(F.regexp_replace(_col(c), r"(?U)" + LINK, ""))


def post_text(promotion, url) -> Column:
    """P18. Post body: promotion, newline, URL."""
    return F.concat(_col(promotion), F.lit("\n"), _col(url))
