"""Personal data by DataFrame functions alone: base patterns, and contexts bootstrapped from them.

Base spans (kinds email, ip, card, phone) always stay. Seeds are the identifier-like tokens inside
base spans (a token: a word with a digit or an @, and the blocks of digits that follow it after single
blanks, so that a number written in blocks is one). Tokens below ``VALUE_CHARS`` characters name nobody. Each token has two lexical patterns: the word
before it, or after it, with the token's shape. Patterns and tokens form a graph, scored in turns:
a pattern's confidence is the share of its distinct tokens that are believed to be personal data; a
token's is the noisy-or of its patterns. Patterns that reach ``CONFIDENT`` with ``SUPPORT`` distinct
seeds then mark their other tokens as kind ``found``.

The patterns are written with possessive quantifiers, so no text makes them backtrack or recurse.
Positions come from splitting at a mark put around every match; that private-use character is
replaced by another one of the same length where a text holds it. Null and empty texts have no
spans. Every row is scanned on its own, repeated ids too. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

MARK = "\ue000"
OTHER = "\ue001"
KINDS = ("email", "ip", "card", "phone")
FOUND = "found"
# Documented parameters.
CONTEXT = 40
VALUE_CHARS = 6
SUPPORT = 5
CONFIDENT = 0.9
ROUNDS = 3

# The base patterns. A match starts where a run of its first class starts, or where the last match
# ended; that is where the leftmost match of the plain pattern starts.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# blocks of digits that follow after single blanks belong to the same mention
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20\(?[0-9]++(?:[().-]++[0-9]++)*+\)?[.,;:!?]?(?!\S))*+"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SPAN = "array<struct<kind: string, start: bigint, end: bigint>>"


def _cut(text: Column, pattern: str) -> Column:
    """The text around and inside the matches, in turns; every second part is a match."""
    return F.split(F.regexp_replace(text, pattern, MARK + "$0" + MARK), MARK)


def _starts(parts: Column) -> Column:
    """Where each part starts, in code points."""
    return F.aggregate(
        parts, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all")),
        lambda acc, p: F.struct((acc["at"] + F.char_length(p)).alias("at"),
                                F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"])


def _matches(parts: str, starts: str, kind: str, valid) -> Column:
    """Spans of the matches that are valid."""
    index = F.when(F.size(parts) > 2, F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2))).otherwise(
        F.array().cast("array<int>"))
    found = F.filter(index, lambda i: valid(F.get(parts, i)))
    return F.transform(found, lambda i: F.struct(
        F.lit(kind).alias("kind"), F.get(starts, i).alias("start"),
        (F.get(starts, i) + F.char_length(F.get(parts, i))).alias("end")))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    digits = F.reverse(_digits(text))
    n = F.char_length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda acc, i: acc + _luhn_digit(F.substring(digits, i, F.lit(1)).cast("int"), i))
    return F.when(n.between(16, 19), total % 10 == 0).otherwise(False)


def _luhn_digit(digit: Column, place: Column) -> Column:
    return F.when(place % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)


VALID = {
    "email": (EMAIL, "[A-Za-z0-9]@[A-Za-z0-9-]|[._%+-]@[A-Za-z0-9-]", lambda m: F.lit(True)),
    "ip": (IP, r"[0-9]\.[0-9]", lambda m: m.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")),
    "card": (CARD, r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", _luhn),
    "phone": (PHONE, r"\+[0-9]", lambda m: F.char_length(_digits(m)).between(8, 15)),
}


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans by kind, and the identifier-like tokens with the text beside them."""
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(OTHER))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # most texts have nothing of a kind: a plain search decides before anything is cut
    for kind, (pattern, hint, _) in VALID.items():
        df = df.withColumn(f"p_{kind}", F.when(F.col("text").rlike(hint), _cut(F.col("text"), pattern)))
    df = df.withColumn("p_token", F.when(F.col("text").rlike("[0-9@]"), _cut(F.col("text"), TOKEN))).drop("text")
    for kind in (*VALID, "token"):
        df = df.withColumn(f"s_{kind}", _starts(F.col(f"p_{kind}")))
    none = F.array().cast(SPAN)
    for kind, (_, _, valid) in VALID.items():
        df = df.withColumn(kind, F.coalesce(_matches(f"p_{kind}", f"s_{kind}", kind, valid), none))
    index = F.when(F.size("p_token") > 2, F.sequence(F.lit(1), F.size("p_token") - 2, F.lit(2)))
    tokens = F.transform(index, lambda i: F.struct(
        F.get("s_token", i).alias("start"), F.get("p_token", i).alias("token"),
        F.substring(F.get("p_token", i - 1), -CONTEXT, CONTEXT).alias("before"),
        F.substring(F.get("p_token", i + 1), 1, CONTEXT).alias("after")))
    return df.select("doc_id", F.concat(*KINDS).alias("spans"), tokens.alias("tokens"))


def _mentions(scanned: DataFrame) -> DataFrame:
    """One row per token: its place, its trimmed value, its shape, the words beside it, seed or not."""
    one = scanned.select("rid", "spans", F.explode("tokens").alias("t"))
    head = F.regexp_extract("t.token", r"^[^\p{L}\p{N}+]*+", 0)
    core = F.regexp_replace(F.expr("substring(t.token, char_length(head) + 1)"), r"[^\p{L}\p{N}]++$", "")
    one = one.withColumn("head", head).withColumn("value", core)
    one = one.withColumn("start", F.col("t.start") + F.char_length("head"))
    one = one.withColumn("end", F.col("start") + F.char_length("value"))
    one = one.filter(F.char_length("value") >= VALUE_CHARS)  # shorter ones name nobody
    seed = F.exists("spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    shape = F.regexp_replace(F.regexp_replace("value", r"\p{L}++", "a"), r"\p{N}++", "9")
    word = (F.lower(F.regexp_extract("t.before", r"(\S++)\s*$", 1)), F.lower(F.regexp_extract("t.after", r"^\s*+(\S++)", 1)))
    return one.select("rid", "start", "end", F.lower("value").alias("value"), seed.alias("seed"), F.array(
        F.concat_ws(" ", F.lit("after"), word[0], shape), F.concat_ws(" ", F.lit("before"), word[1], shape)).alias("patterns"))


def bootstrap(mentions: DataFrame, at: str, rounds: int = ROUNDS, support: int = SUPPORT,
              confident: float = CONFIDENT) -> DataFrame:
    """Patterns that are trusted, from turns of scoring over the written pattern-token graph."""
    spark = mentions.sparkSession
    edges = mentions.select(F.explode("patterns").alias("pattern"), "value", "seed").groupBy("pattern", "value").agg(
        F.max("seed").alias("seed"))
    edges.write.parquet(f"{at}/edges")
    edges = spark.read.parquet(f"{at}/edges")
    # a pattern that no seed has can only matter to tokens of patterns that have one
    belief = edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("belief"))
    for turn in range(rounds):
        scored = edges.join(belief, "value").groupBy("pattern").agg(
            F.sum("belief").alias("mass"), F.count(F.lit(1)).alias("n"), F.sum(F.col("seed").cast("long")).alias("seeds"))
        scored = scored.filter("mass > 0").select("pattern", "seeds", (F.col("mass") / F.col("n")).alias("confidence"))
        scored.write.parquet(f"{at}/patterns-{turn}")
        scored = spark.read.parquet(f"{at}/patterns-{turn}")
        if turn + 1 < rounds:
            # patterns with little support give little: their confidence is drawn towards zero
            weight = F.col("confidence") * F.col("seeds") / (F.col("seeds") + support)
            belief = edges.join(scored, "pattern").groupBy("value").agg(
                F.max("seed").alias("seed"), F.sum(F.log1p(-F.least(weight, F.lit(0.999)))).alias("doubt"))
            belief = belief.select("value", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp("doubt")).alias("belief"))
            belief.write.parquet(f"{at}/belief-{turn}")
            belief = spark.read.parquet(f"{at}/belief-{turn}")
    return scored.filter((F.col("seeds") >= support) & (F.col("confidence") >= confident)).select("pattern")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end) by kind as listed, then start; found last."""
    spark = docs.sparkSession
    at = scratch_dir(spark, "pii")
    base_spans(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()).write.parquet(f"{at}/base")
    scanned = spark.read.parquet(f"{at}/base")
    _mentions(scanned).write.parquet(f"{at}/mentions")
    mentions = spark.read.parquet(f"{at}/mentions")
    trusted = bootstrap(mentions, at)
    fresh = (mentions.filter("not seed").select("rid", "start", "end", F.explode("patterns").alias("pattern"))
             .join(trusted, "pattern", "left_semi").select("rid", "start", "end").distinct())
    fresh = fresh.groupBy("rid").agg(F.sort_array(F.collect_list(
        F.struct("start", "end"))).alias("found"))
    found = F.coalesce(F.transform("found", lambda s: F.struct(
        F.lit(FOUND).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), F.array().cast(SPAN))
    return scanned.select("rid", "doc_id", "spans").join(fresh, "rid", "left").select(
        "doc_id", F.concat("spans", found).alias("spans"))
