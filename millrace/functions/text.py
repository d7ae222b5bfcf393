"""Text functions as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that negate a phrase after them, and how many characters before a phrase count.
NEGATION = {"zh": (("不", "没", "別", "别", "勿"), 8), "en": ((" not ", "don't ", "dont ", "can't ", "cannot ", "won't ", "never "), 24)}


def strip_text(text: Column) -> Column:
    """The text without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def slugify(name: Column) -> Column:
    """Lower-case letters, digits and CJK with single underscores; `untitled` if nothing is left."""
    kept = F.regexp_replace(F.lower(strip_text(name)), r"(?U)[^a-z0-9一-鿿\s_-]", "")
    slug = F.trim(F.regexp_replace(kept, r"(?U)[\s-]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("untitled"))


def preview(text: Column, most: int) -> Column:
    """White space collapsed, cut with `...` to so many characters."""
    flat = strip_text(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, most - 3)), F.lit("...")))


def percent_encode(key: Column) -> Column:
    return F.replace(F.url_encode(key), F.lit("+"), F.lit("%20"))


def percent_decode(name: Column) -> Column:
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def contains_any(text: Column, phrases) -> Column:
    """Whether any phrase occurs, whatever its case."""
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(F.lower(text), F.lit(p.lower()))
    return out


def affirmative(text: Column, phrase: str, lang: str) -> Column:
    """Whether a phrase occurs without a negation shortly before it."""
    words, width = NEGATION[lang]
    phrase = phrase.lower()
    parts = F.split(F.lower(text), rf"\Q{phrase}\E")

    def step(s, part):
        before = F.right(F.concat(s["tail"], part), F.lit(width))
        clean = F.lit(True)
        for w in words:
            clean = clean & ~F.contains(before, F.lit(w))
        return F.struct(F.right(F.concat(before, F.lit(phrase)), F.lit(width)).alias("tail"), (s["hit"] | clean).alias("hit"))

    # one pass: an occurrence follows each part but the last, and only the characters before it are kept
    start = F.struct(F.lit("").alias("tail"), F.lit(False).alias("hit"))
    return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), start, step, lambda s: s["hit"])


def affirmative_any(text: Column, phrases, lang: str) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | affirmative(text, p, lang)
    return out


def without_fences(text: Column) -> Column:
    """A text that starts with a code fence, without its fence lines."""
    lines = F.filter(F.split(strip_text(text), "\n"), lambda line: ~F.startswith(F.ltrim(line), F.lit("```")))
    return F.when(F.startswith(strip_text(text), F.lit("```")), strip_text(F.array_join(lines, "\n"))).otherwise(strip_text(text))


def first_object(text: Column) -> Column:
    """The first balanced {...} of a text, braces in quoted strings apart; null if there is none.

    One pass over the characters from the first brace: state is (depth, in a string, after a backslash, length, done).
    """
    tail = F.substr(text, F.greatest(F.instr(text, "{"), F.lit(1)))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"), F.lit(0).alias("size"), F.lit(False).alias("done"))

    def step(s, c):
        quote = (c == '"') & ~s["escaped"]
        depth = s["depth"] + F.when(s["quoted"] | s["done"], 0).when(c == "{", 1).when(c == "}", -1).otherwise(0)
        return F.struct(
            depth.alias("depth"), F.when(quote, ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"), (s["quoted"] & (c == "\\") & ~s["escaped"]).alias("escaped"),
            F.when(s["done"], s["size"]).otherwise(s["size"] + 1).alias("size"), (s["done"] | (~s["quoted"] & (c == "}") & (depth == 0))).alias("done"),
        )

    end = F.aggregate(F.split(tail, ""), start, step)
    return F.when((F.instr(text, "{") > 0) & end["done"], F.substr(tail, F.lit(1), end["size"]))


def parsed_object(text: Column) -> Column:
    """A JSON object as a variant: the whole text, or the first balanced object in it; null if neither is an object."""
    whole = F.try_parse_json(without_fences(text))
    part = F.try_parse_json(first_object(without_fences(text)))
    is_object = lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    return F.when(is_object(whole), whole).when(is_object(part), part)


def error_summary(errors: Column, shown: int = 3) -> Column:
    """The first errors, and how many more there are."""
    text = F.array_join(F.slice(errors, 1, shown), "; ")
    return F.when(F.size(errors) > shown, F.concat(text, F.format_string(" (+%d more)", F.size(errors) - shown))).otherwise(text)


def bar(percent: Column) -> Column:
    return F.repeat(F.lit("█"), F.greatest(F.lit(1), F.floor(percent).cast("int")))
