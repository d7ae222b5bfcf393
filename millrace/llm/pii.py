"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score, which decides.

Spans of the base kinds all stay, with their score. Of the kinds that the method adds, account numbers and secrets, those stay that
reach a score of ACCEPT: a number does by its checksum, a secret, which has none, only by a word nearby.

Built-in expressions only, and no shuffle: each text is judged in its row. Java's regular expressions recurse on repeated groups,
so groups are possessive, and a search starts only where a run of its characters starts; neither changes what matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of an account number by country, as registered under ISO 13616.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(c for x in IBAN_SIZES.values() for c in x.split())
#: A number of a registered country has that country's size; of any other code, what may be one, with the rest of its last word.
_NUMBER = "|".join([
    *[rf"(?:{x.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]){{{n - 4}}}+(?![A-Za-z0-9])" for n, x in IBAN_SIZES.items()],
    rf"(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:[ ]?[A-Z0-9]){{11,30}}+[A-Za-z0-9]*+",
])
KINDS = ("email", "ip", "card", "phone", "iban", "secret")
ADDED = ("iban", "secret")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a match of the base pattern is a maximal run, so a run of 13 to 19 digits is a match with so many digits
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # only the first four characters are consumed, so that a number is also tried where an earlier try reaches into it
    "iban": rf"(?<![A-Za-z0-9])(?=({_NUMBER}))[A-Z]{{2}}[0-9]{{2}}",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}+",
}
#: Words that make a kind likelier within CONTEXT code points before a span.
WORDS = {
    "email": r"(?i)mail|contact|kontakt|correo|courriel",
    "ip": r"(?i)\bip\b|host|server|address|adresse",
    "card": r"(?i)card|visa|karte|tarjeta|carte|payment",
    "phone": r"(?i)phone|tel|call|mobile|fax",
    "iban": r"(?i)iban|account|konto|cuenta|compte|bank",
    "secret": r"(?i)token|secret|passw|passphrase|credential|bearer|auth|api.?key|private.?key|access.?key",
}
CONTEXT, BASE_SCORE, WORD_SCORE, ACCEPT = 40, {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.6, "secret": 0.4}, 0.2, 0.6
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _luhn(digits: Column) -> Column:
    """Whether the digits pass: of every second one from the right the double, less 9 if above 9."""
    parts = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, F.ascii(c) - 48).otherwise((F.ascii(c) - 48) * 2 - F.when(F.ascii(c) > 52, 9).otherwise(0)))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(iban: Column) -> Column:
    """Whether an account number, its first four characters last and letters as 10 to 35, leaves 1 by 97."""
    code = F.upper(F.replace(iban, F.lit(" "), F.lit("")))
    turned = F.concat(F.substr(code, F.lit(5)), F.substring(code, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: (a * F.when(F.ascii(c) >= 65, 100).otherwise(10) + F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)) % 97) == 1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"),
    "card": lambda m: _luhn(_digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
    # letters and digits mixed, as random strings have them, and not words or numbers
    "secret": lambda m: m.rlike("[0-9].*[0-9].*[0-9].*[0-9]") & m.rlike("[A-Za-z].*[A-Za-z].*[A-Za-z].*[A-Za-z]"),
    "iban": lambda m: m.rlike("^[A-Z0-9 ]+$") & F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34) & _mod97(m),
}


def _confirmed(kind: str, match: Column) -> Column:
    """The span of a match that passes the kind's check, or null. A number of unregistered size is the longest run of its words that passes."""
    passes = lambda m: F.coalesce(CHECKS[kind](m), F.lit(False))
    if kind != "iban":
        return F.when(passes(match), match)
    words = F.split(match, " ")
    runs = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    runs = F.when(match.rlike(f"^(?:{_KNOWN})"), F.array(match)).otherwise(runs)
    return F.get(F.filter(runs, passes), F.lit(0))


def _running(sizes: Column, chunk: int = 256) -> Column:
    """The sums of an array's elements up to each one. Appending copies what is there, so it is done within chunks, then over them."""
    def sums(x):
        return F.aggregate(x, F.array().cast("array<long>"), lambda out, n: F.concat(out, F.array(F.coalesce(F.get(out, F.size(out) - 1), F.lit(0).cast("long")) + n)))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / chunk).cast("int")), lambda c: sums(F.slice(sizes, c * chunk + 1, F.lit(chunk))))
    ends = F.transform(chunks, lambda c: F.get(c, F.size(c) - 1))
    whole = F.zip_with(chunks, sums(ends), lambda c, end: F.transform(c, lambda x: x + end - F.get(c, F.size(c) - 1)))
    return F.when(F.size(sizes) > 0, F.flatten(whole)).otherwise(F.array().cast("array<long>"))


def _placed(text: Column, kind: str) -> Column:
    """array of (start, m): the matches of a kind that pass its check, by start."""
    matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)
    ends = _running(F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: (F.length(g) + F.length(m)).cast("long")))
    spans = F.zip_with(ends, matches, lambda end, m: F.struct((end - F.length(m)).cast("int").alias("start"), _confirmed(kind, m).alias("m")))
    return F.filter(spans, lambda s: s["m"].isNotNull())


def _placed_numbers(text: Column) -> Column:
    """_placed for account numbers, whose matches are tried at each start and may reach into the next ones."""
    pattern = F.lit(PATTERNS["iban"])
    matches = [F.regexp_extract_all(text, pattern, F.lit(i)).alias(n) for n, i in (("m", 0), ("whole", 1))]
    pairs = F.arrays_zip(*matches, F.split(text, PATTERNS["iban"], -1).alias("gap"))
    empty = F.array().cast("array<struct<start:int,m:string>>")

    def step(a, p):
        start = a["at"] + F.length(p["gap"])
        span = F.when(p["m"].isNotNull() & (start >= a["free"]), _confirmed("iban", p["whole"]))
        return F.struct(
            (start + F.coalesce(F.length(p["m"]), F.lit(0))).alias("at"), F.coalesce(start + F.length(span), a["free"]).alias("free"),
            F.when(span.isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(start.alias("start"), span.alias("m"))))).alias("out"),
        )

    # free: where the last span ends, before which no other one starts
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), empty.alias("out")), step, lambda a: a["out"])


def find_spans(text: Column, kind: str) -> Column:
    """array of (kind, start, end, score): the matches of a kind in a text that pass its check, by start, in code points."""
    near = lambda s: F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
    spans = F.transform(_placed_numbers(text) if kind == "iban" else _placed(text, kind), lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["m"])).alias("end"),
        F.round(F.lit(BASE_SCORE[kind]) + F.when(near(s).rlike(WORDS[kind]), WORD_SCORE).otherwise(0.0), 2).alias("score"),
    ))
    return F.filter(spans, lambda s: s["score"] >= ACCEPT) if kind in ADDED else spans


def with_spans(docs: DataFrame, *, text: str = "text", carry: tuple[str, ...] = ("doc_id",), kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """row (a struct of the carried columns) and one array of (kind, start, end, score) for each kind, for each row of docs.

    Null and empty texts have no spans; repeated rows are judged one by one; an empty table gives no rows; columns of any name
    are carried within row. Kinds are searched apart: where spans of two kinds overlap, both stay. A very long text is searched
    whole, in time proportional to its length but for its matches, which are placed in chunks. A text is searched for a kind only
    if it has the characters that every match of it has.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("text"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    may = {"email": body.contains("@"), "ip": body.contains("."), "card": body.rlike("[0-9][ -]?[0-9]"), "phone": body.contains("+"), "iban": body.rlike("[A-Z]{2}[0-9]{2}"), "secret": body.rlike("[A-Za-z0-9_]{20}")}
    return rows.select("row", *[F.when(may[k], find_spans(body, k)).otherwise(none).alias(k) for k in kinds])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: every document."""
    found = with_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base, all_ = F.concat("email", "ip", "card", "phone"), F.concat(*KINDS)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS if k not in ADDED]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(all_).alias("spans"))


def _spans_sql(kind: str, pattern: str, check: str, group: str = "") -> str:
    """(doc_id, kind, start, m) of the matches of a pattern; what is before a match is what the split leaves and the matches before."""
    return f"""SELECT doc_id, '{kind}' AS kind, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start, ms[i] AS m, t
  FROM (SELECT doc_id, t, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gaps FROM d)) WHERE {check}"""


_D = "regexp_replace(ms[i], '[^0-9]', '', 'g')"
_MOD = "list_reduce(list_prepend(0, list_transform(string_split(substr(c, 5) || left(c, 4), ''), lambda x: CASE WHEN x >= 'A' THEN ascii(x) - 55 ELSE x::INT END)), lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97)"
_SIZED = "|".join(f"(?:{x.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, x in IBAN_SIZES.items())
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS ({_spans_sql("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+".replace(chr(92) * 2, chr(92)), "true")}
UNION ALL {_spans_sql("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(ms[i], '.'), lambda x: length(ltrim(x, '0')) > 3 OR lpad(ltrim(x, '0'), 3, '0') > '255')) = 0")}
UNION ALL {_spans_sql("card", r"[0-9](?:[ -]?[0-9])+", f"length({_D}) BETWEEN 13 AND 19 AND list_sum(list_transform(string_split(reverse({_D}), ''), lambda x, j: CASE WHEN j % 2 = 1 THEN x::INT WHEN x::INT > 4 THEN 2 * x::INT - 9 ELSE 2 * x::INT END)) % 10 = 0")}
UNION ALL {_spans_sql("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_D}) BETWEEN 9 AND 15")}),
n AS (SELECT *, replace(m, ' ', '') AS c FROM ({_spans_sql("iban", _SIZED, "true")})),
a AS (SELECT doc_id, kind, start, m FROM n WHERE {_MOD} = 1 AND NOT regexp_matches(substr(t, start, least(start, 1)), '[A-Za-z0-9]') AND NOT regexp_matches(substr(t, start + length(m) + 1, 1), '[A-Za-z0-9]')
UNION ALL SELECT doc_id, kind, start, m FROM ({_spans_sql("secret", "[A-Za-z0-9_]{20,}", "length(regexp_replace(ms[i], '[^0-9]', '', 'g')) > 3 AND length(regexp_replace(ms[i], '[^A-Za-z]', '', 'g')) > 3")})
  WHERE regexp_matches(substr(t, greatest(start - {CONTEXT}, 0) + 1, least(start, {CONTEXT})), '{WORDS["secret"]}')),
s AS (SELECT doc_id, kind, start, kind || ':' || start || ':' || start + length(m) AS x, list_position(['email', 'ip', 'card', 'phone', 'iban', 'secret'], kind) AS k FROM (SELECT doc_id, kind, start, m FROM b UNION ALL SELECT * FROM a)),
g AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))}, string_agg(x, ',' ORDER BY k, start) FILTER (k <= 4) AS base, string_agg(x, ',' ORDER BY k, start) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("email", "ip", "card", "phone"))}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""
