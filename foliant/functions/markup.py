"""Clean-up passes and token tables that are plain column expressions.

Every repeated group in the patterns is possessive: Java's engine would otherwise recurse once for
each character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What a markup token is.
SKIP = "<!--[\\s\\S]*?-->|<!\\[CDATA\\[[\\s\\S]*?\\]\\]>|<\\?(?:[^?]|\\?(?!>))*+\\?>|<![^>]*>"
ATTRIBUTES = "(?:\"[^\"]*\"|'[^']*'|[^'\">]++)*+"
NAME = "[A-Za-z][A-Za-z0-9:._-]*"
TAG = f"<(/?)({NAME})\\b({ATTRIBUTES})>"
TOKEN = f"{SKIP}|<(?:/?)(?:{NAME})\\b(?:{ATTRIBUTES})>"
STYLE = "(?i)(?:^|\\s)style\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s>]+))"
ROOT = f"(?i)<html\\b{ATTRIBUTES}>"
NAMESPACE = "(?i)\\s+xmlns(?::[A-Za-z_][A-Za-z0-9_.-]*)?\\s*=\\s*(?:\"[^\"]*\"|'[^']*'|[^\\s>]+)"


def remove_scripts(text: Column) -> Column:
    return F.regexp_replace(text, "(?i)<script\\b[^>]*>[\\s\\S]*?</script\\s*>", "")


def remove_root_namespaces(text: Column) -> Column:
    """Namespace declarations of the first html tag."""
    tag = F.regexp_extract(text, f"({ROOT})", 1)
    at = F.regexp_instr(text, F.lit(ROOT))
    clean = F.regexp_replace(tag, NAMESPACE, "")
    whole = F.concat(F.substring(text, F.lit(1), at - 1), clean, F.substring(text, at + F.length(tag), F.length(text)))
    return F.when((tag != "") & (clean != tag), whole).otherwise(text)


_SPACE = "\\s(?!href\\s*=)"
_NO_HREF = f"(?:\"(?:[^\"\\s]++|{_SPACE})*+\"|'(?:[^'\\s]++|{_SPACE})*+'|[^'\">\\s]++|{_SPACE})*+"
EMPTY_ANCHOR = f"(?iU)({SKIP})|<a\\b(?![A-Za-z0-9:._-])(?:{_NO_HREF}(?<=/\\s{{0,64}})>|{_NO_HREF}>\\s*</a\\b(?![A-Za-z0-9:._-]){ATTRIBUTES}>)|(</?{NAME}\\b{ATTRIBUTES}>)"


def remove_empty_anchors(text: Column) -> Column:
    """Anchors without address and content. Other tokens, comments among them, are matched first and put back."""
    return F.regexp_replace(text, EMPTY_ANCHOR, "$1$2")


def style_value(attributes: Column) -> Column:
    """Value of a style attribute, null where there is none."""
    parts = [F.regexp_extract(attributes, STYLE, k) for k in (1, 2, 3)]
    return F.when(attributes.rlike(STYLE), F.concat(*parts))


def markup_tokens(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, pos, name, closing, self_closing, attributes, length) of the tags of each text, in their order.

    ``pos`` counts all tokens, also comments and declarations, which give no rows; ``length`` is the token's, in characters.
    """
    tokens = df.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0))).alias("pos", "token"))
    return _tags(tokens, key).withColumn("length", F.char_length("token").cast("long")).drop("token")


def _tags(tokens: DataFrame, key: str) -> DataFrame:
    """Adds what the tags among the tokens (key, pos, token, ...) say; other tokens are left out."""
    part = lambda k: F.regexp_extract("token", f"^{TAG}$", k)
    tags = tokens.where(F.col("token").rlike("^</?[A-Za-z]"))
    more = [c for c in tokens.columns if c not in (key, "pos")]
    return tags.select(
        key, "pos", F.lower(part(2)).alias("name"), (part(1) == "/").alias("closing"), F.rtrim(part(3)).endswith("/").alias("self_closing"), part(3).alias("attributes"), *more
    )


def token_offsets(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``markup_tokens`` with ``offset``, the characters before each token: a running sum of the lengths of tokens and of the gaps before them.

    ``key`` is unique. Texts move no further than their tokens' lengths; a window holds the tokens of one document.
    """
    tokens, gaps = F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)), F.split(F.col(text), TOKEN, -1)
    gap_sizes = F.transform(gaps, lambda g: F.char_length(g).cast("long"))
    both = F.arrays_zip(tokens.alias("token"), F.slice(gap_sizes, F.lit(1), F.size(tokens)).alias("gap"))
    rows = df.where(F.col(text).isNotNull()).select(key, F.posexplode(both).alias("pos", "at")).select(key, "pos", "at.token", "at.gap")
    rows = rows.withColumn("length", F.char_length("token").cast("long"))
    before = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("offset", F.sum(F.col("gap") + F.col("length")).over(before) - F.col("length")).drop("gap")
    return _tags(rows, key).drop("token")


def matching_closes(tokens: DataFrame, key: str) -> DataFrame:
    """(key, name, open, close, open_offset, open_length, close_offset, close_length): each opening tag and the tag that closes it, null where none does.

    ``tokens`` are those of ``token_offsets``. Where the running depth of a name comes up to a level, the next tag that goes down from that level closes it; ups and downs of one level take
    turns. Self-closing tags open nothing; closing tags without an opening one are no one's.
    """
    steps = token_depth(tokens.where(F.col("closing") | ~F.col("self_closing")), key)
    level = F.col("depth") + F.col("closing").cast("int")
    order = W.partitionBy(key, "name", "level").orderBy("pos")
    next_of = lambda c: F.lead(c).over(order)
    rows = steps.withColumn("level", level).withColumn("next", F.when(next_of("closing"), F.struct(next_of("pos").alias("pos"), next_of("offset").alias("offset"), next_of("length").alias("length"))))
    return rows.where(~F.col("closing")).select(
        key, "name", F.col("pos").alias("open"), F.col("next.pos").alias("close"), F.col("offset").alias("open_offset"), F.col("length").alias("open_length"),
        F.col("next.offset").alias("close_offset"), F.col("next.length").alias("close_length"),
    )


def token_depth(tokens: DataFrame, key: str) -> DataFrame:
    """Adds depth: open elements of a tag's name after it. Self-closing tags count nothing."""
    step = F.when(F.col("self_closing") & ~F.col("closing"), 0).when(F.col("closing"), -1).otherwise(1)
    order = W.partitionBy(key, "name").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    return tokens.withColumn("depth", F.sum(step).over(order).cast("long"))


def unbalanced_tags(tokens: DataFrame, key: str) -> DataFrame:
    """(key, name, open) of each document and element name whose tags don't balance."""
    step = F.when(F.col("self_closing") & ~F.col("closing"), 0).when(F.col("closing"), -1).otherwise(1)
    return tokens.groupBy(key, "name").agg(F.sum(step).cast("long").alias("open")).where("open <> 0")


def markup_profile(tokens: DataFrame, key: str) -> DataFrame:
    """Opening tags, and documents that have them, by element name."""
    return tokens.where(~F.col("closing")).groupBy("name").agg(F.count("*").alias("tags"), F.countDistinct(key).alias("documents"))


def strip_tags(text: Column) -> Column:
    """Text without tokens, trimmed of Unicode white space."""
    return F.regexp_replace(F.regexp_replace(text, TOKEN, ""), "(?U)^\\s+|\\s+$", "")


#: Named references that a marker cell may hold.
MARKERS = [("&bull;", "\u2022"), ("&middot;", "\u00b7"), ("&nbsp;", "\u00a0")]


def changed_by_pass(df: DataFrame, key: str, text: str, passes: dict[str, Column]) -> DataFrame:
    """(key, pass) for each pass, applied alone, that alters a document."""
    rows = F.array(*[F.when(~c.eqNullSafe(F.col(text)), F.lit(n)) for n, c in passes.items()])
    return df.select(key, F.explode(F.array_compact(rows)).alias("pass"))
