"""Quality rules: one threshold table compiled into one Spark projection.

The counts (words, characters, symbols, lines, stop words, repeated windows)
are built-in array and string expressions, the verdict is a conjunction
compiled from ``RULES``; nothing runs outside the JVM and nothing shuffles.
Ratios are compared as integer products, so every engine agrees on ties.

Defined results: null text has no words and fails the base rules; an empty
table gives no rows; repeated rows each get their own verdict; extra columns
are ignored. A text of any length is counted whole, in time linear in its
words unless it repeats windows (then one sort of its windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

# Frequent function words of four languages, lower case.
STOP_WORDS = """
the of and to in is that it for on with as are this be by at from was or an have not a
der die und das den von mit des auf ist im dem nicht ein eine als auch es an für sich
de la le et les des en un du une que est pour qui dans par sur pas au il
el los las por con para su al del lo como más o pero sus y no se
""".split()

#: (name, part, whole, least percent, most percent, from words): part * 100 is
#: held between least * whole and most * whole in texts of so many words or
#: more; None leaves a side open.
RULES = [
    ("mean_word_length", "word_chars", "n_words", 200, 1500, 0),
    ("symbol_ratio", "n_symbols", "n_words", None, 25, 0),
    ("shout_ratio", "n_shouts", "n_words", None, 25, 0),
    ("stop_word_ratio", "n_stop_words", "n_words", 4, None, 40),
    ("adjacent_repeat_ratio", "n_adjacent", "n_words", None, 30, 0),
    ("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 40, 0),
    ("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 30, 0),
    ("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 90, 0),
]
BASE_WORDS, BASE_REPEAT = 10, 20


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and every count that a rule may name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    a = docs.select(
        "doc_id",
        F.array_remove(F.split(text, GAP), "").alias("words"),
        F.filter(F.split(text, "\n"), has_word).alias("lines"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    b = a.select("doc_id", "words", "lines", "n_symbols", hashes.alias("h"))
    window = F.transform(
        F.slice("h", 1, F.greatest(F.size("h") - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get("h", i + k) for k in range(1, WINDOW)]))
    c = b.select("doc_id", "words", "lines", "n_symbols", window.alias("win"))
    # Only texts that repeat a window are sorted to find where.
    c = c.withColumn("pairs", F.when(
        F.size(F.array_distinct("win")) < F.size("win"),
        F.array_sort(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    twice = F.filter(F.transform("pairs", lambda p, j: F.when(
        F.coalesce(F.get("pairs", j - 1)["x"] == p["x"], F.lit(False))
        | F.coalesce(F.get("pairs", j + 1)["x"] == p["x"], F.lit(False)), p["i"])), lambda i: i.isNotNull())
    d = c.select("doc_id", "words", "lines", "n_symbols", F.array_sort(twice).alias("starts"))
    covered = F.aggregate(
        F.transform("starts", lambda s, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get("starts", j + 1) - s, F.lit(WINDOW)))),
        F.lit(0), lambda acc, x: acc + x)
    number = lambda c: F.size(c).cast("long")
    return d.select(
        "doc_id", number("words").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (number("lines") - number(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        number("lines").alias("n_lines"),
        number(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stop_words"),
        number(F.filter("words", lambda w: w.endswith("!!"))).alias("n_shouts"),
        number(F.filter("words", lambda w, i: w == F.get("words", i - 1))).alias("n_adjacent"),
        number(F.filter("lines", lambda x: x.endswith("..."))).alias("n_ellipsis_lines"),
        number(F.filter("lines", lambda x: x.startswith("- ") | x.startswith("* "))).alias("n_bullet_lines"))


def compiled(rules=RULES) -> Column:
    """The whole table as one boolean expression."""
    out = F.lit(True)
    for _, part, whole, least, most, words in rules:
        short = F.col("n_words") < words
        if least is not None:
            out = out & (short | (F.col(part) * 100 >= F.col(whole) * least))
        if most is not None:
            out = out & (short | (F.col(part) * 100 <= F.col(whole) * most))
    return out


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """Counts, base_failed and kept per row of ``docs`` (doc_id, text)."""
    failed = (F.col("n_words") < BASE_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_REPEAT)
    return counts(docs).select("*", failed.alias("base_failed"), (~failed & compiled(rules)).alias("kept"))


def op6(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_rules(rules=RULES) -> str:
    out = []
    for _, part, whole, least, most, words in rules:
        out += [f"(n_words < {words} or {part} * 100 >= {whole} * {least})"] if least is not None else []
        out += [f"(n_words < {words} or {part} * 100 <= {whole} * {most})"] if most is not None else []
    return " and ".join(out)


_STOP_SQL = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))
SQL = f"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (
  select r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines from d),
p as (
  select r, i, list_aggregate(words[i:i + {WINDOW - 1}], 'string_agg', ' ') as win
  from (select r, words, unnest(range(1, len(words) - {WINDOW - 2})) as i from w where len(words) >= {WINDOW})),
q as (select r, i, count(*) over (partition by r, win) as n from p),
s as (
  select r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as nxt from q where n >= 2) group by r),
c as (
  select doc_id, cast(len(words) as bigint) as n_words,
    cast(length(array_to_string(words, '')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    cast(len(lines) as bigint) as n_lines,
    cast(len(list_filter(words, lambda x: lower(x) in ({_STOP_SQL}))) as bigint) as n_stop_words,
    cast(len(list_filter(words, lambda x: ends_with(x, '!!'))) as bigint) as n_shouts,
    cast(len(list_filter(words, lambda x, i: x = words[i - 1] and i > 1)) as bigint) as n_adjacent,
    cast(len(list_filter(lines, lambda x: ends_with(x, '...'))) as bigint) as n_ellipsis_lines,
    cast(len(list_filter(lines, lambda x: starts_with(x, '- ') or starts_with(x, '* '))) as bigint) as n_bullet_lines
  from w left join s using (r)),
b as (
  select *, n_words < {BASE_WORDS} or n_repeat_words * 100 > n_words * {BASE_REPEAT} as base_failed from c)
select *, not base_failed and {_sql_rules()} as kept from b
"""
