"""Unicode folding in the JVM: compatibility decomposition, drop what is not ASCII, lower case.

Spark has no Unicode normalisation builtin. Since everything outside ASCII is
dropped afterwards, decomposition is a table from one code point to the ASCII
letters in its decomposition. Code points that become one letter go through
``translate``, the few that become several through a map, and only in texts
that hold one. No Python runs on the rows.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def ascii_table() -> tuple[dict[str, str], dict[str, str]]:
    """(code points that become one ASCII letter, code points that become several)."""
    one, several = {}, {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode("ascii")
        if plain:
            (one if len(plain) == 1 else several)[c] = plain
    return one, several


def fold_text(text: Column) -> Column:
    """NFKD without its non-ASCII part, in lower case; null stays null."""
    one, several = ascii_table()
    held = F.concat(F.lit("["), F.lit("".join(several)), F.lit("]"))
    letters = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    spelled = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.coalesce(letters[c], c)), "")
    text = F.when(F.regexp_like(text, held), spelled).otherwise(text)
    return F.lower(F.regexp_replace(F.translate(text, "".join(one), "".join(one.values())), "[^\\x00-\\x7F]", ""))
