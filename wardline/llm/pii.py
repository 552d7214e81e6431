"""Personal data in texts: patterns propose spans, checksums confirm, nearby words add to the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A match starts where the last one ended or at the start of a run of its characters: the same
# matches as without that condition, but a run of a million letters is tried once. Repetition is
# possessive where nothing that follows could match less, which also keeps the stack flat.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?<![A-Za-z0-9+.-])(?:\([0-9]{2,4}\) ?)?[0-9]{3}[ -][0-9]{3,4}(?:[ -][0-9]{4})?(?![A-Za-z0-9-])"
# Words that speak for a telephone number or an account close by.
PHONE_WORDS = r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|sms)\b"
ACCOUNT_WORDS = r"(?i)\b(?:iban|account|konto|compte|cuenta|bank|bic|swift)\b"
# Characters before a span that are searched for context words.
NEAR = 40
# Spans with a lower score are dropped; the four base kinds score 1.
LEAST_SCORE = 0.5
# Spans whose offsets are summed up one by one before a chunk's sum is carried on.
CHUNK = 64

KINDS = ("email", "ip", "card", "phone", "iban", "local_phone")
_SPAN = "array<struct<start:int,end:int>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    weighed = F.transform(
        values, lambda v, i: F.when(i % 2 == 0, v).otherwise(2 * v - F.when(v > 4, 9).otherwise(0))
    )
    return F.aggregate(weighed, F.lit(0), lambda total, v: total + v) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without blanks leaves 1 modulo 97, country and check digits last."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(total, c):
        code = F.ascii(c)
        return F.when(code < 65, (total * 10 + code - 48) % 97).otherwise((total * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _is_ip(m: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    value = lambda p: F.substr(p, F.lit(1), F.lit(3)).cast("int")
    return F.forall(parts, lambda p: (F.length(p) < 4) & (value(p) <= 255))


def _is_card(m: Column) -> Column:
    digits = _digits(m)
    return F.length(digits).between(16, 19) & luhn(digits)


def _score(kind: str, m: Column, before: Column) -> Column:
    """0 for a span that its check refutes."""
    if kind == "email":
        return F.lit(1.0)
    if kind == "ip":
        return F.when(_is_ip(m), 1.0).otherwise(0.0)
    if kind == "card":
        return F.when(_is_card(m), 1.0).otherwise(0.0)
    if kind == "phone":
        return F.when(F.length(_digits(m)).between(8, 15), 1.0).otherwise(0.0)
    near = F.right(before, F.lit(NEAR))
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        return F.when(mod97(plain), 0.7 + F.when(near.rlike(ACCOUNT_WORDS), 0.3).otherwise(0.0)).otherwise(0.0)
    return 0.2 + F.when(near.rlike(PHONE_WORDS), 0.5).otherwise(0.0)


# Cheap tests that a text must pass before a pattern is searched in it.
_WORTH = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"(?:[0-9][ -]?){15}[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]"),
    "local_phone": lambda t: t.rlike(r"[0-9]{3}[ -][0-9]{3}") & t.rlike(PHONE_WORDS),
}
_PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, IBAN, LOCAL_PHONE)))


def _with_spans(docs: DataFrame, kind: str) -> DataFrame:
    """Adds the array column `kind` of (start, end) in code points, end exclusive.

    The pieces between matches and the matches themselves make up the text, so their lengths give
    the offsets: sums inside chunks of CHUNK matches plus the sums of the chunks before.
    """
    pattern, text = _PATTERNS[kind], F.col("text")
    worth = _WORTH[kind](text)
    docs = docs.withColumn("_m", F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    some = F.size("_m") > 0
    docs = docs.withColumn("_p", F.when(some, F.split(text, pattern, -1)))
    steps = F.transform("_m", lambda m, i: F.char_length(m) + F.char_length(F.get("_p", i)))
    docs = docs.withColumn("_l", F.when(some, steps))
    chunks = F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / CHUNK).cast("int"))

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda a, b: a + b)

    sums = F.transform(chunks, lambda c: total(F.slice("_l", c * CHUNK + 1, CHUNK)))
    docs = docs.withColumn("_c", F.when(some, sums))
    none = F.array().cast("array<int>")
    bases = F.aggregate(
        "_c",
        F.struct(none.alias("at"), F.lit(0).alias("sum")),
        lambda a, c: F.struct(F.array_append(a["at"], a["sum"]).alias("at"), (a["sum"] + c).alias("sum")),
        lambda a: a["at"],
    )
    docs = docs.withColumn("_b", F.when(some, bases))

    def span(m: Column, i: Column) -> Column:
        chunk = F.floor(i / CHUNK).cast("int")
        end = F.get("_b", chunk) + total(F.slice("_l", chunk * CHUNK + 1, i - chunk * CHUNK + 1))
        score = _score(kind, m, F.get("_p", i))
        return F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), score.alias("score"))

    kept = F.filter(F.transform("_m", span), lambda s: s["score"] >= LEAST_SCORE)
    plain = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    if kind == "local_phone":
        inside = lambda s: F.exists("phone", lambda p: (p["start"] <= s["start"]) & (s["end"] <= p["end"]))
        plain = F.filter(plain, lambda s: ~inside(s))
    found = F.when(some, plain).otherwise(F.array().cast(_SPAN))
    return docs.withColumn(kind, found).drop("_m", "_p", "_l", "_c", "_b")


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and an array of (start, end) for each of KINDS; null text counts as empty.

    E-mail addresses, ip addresses, card numbers and international phone numbers are the base
    kinds. `iban` adds account numbers that pass mod-97, `local_phone` numbers without country
    code where a word such as "phone" stands shortly before, outside the `phone` spans. Matches of a kind do not overlap;
    matches that fail their check are dropped and their characters not tried again.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for kind in KINDS:
        docs = _with_spans(docs, kind)
    return docs


def _listed(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_iban, n_local_phone.

    `spans` lists all spans as kind:start:end, by kind and start; base_sha256 is the digest of
    the base kinds' list. Every row has a result, repeated and empty ones too; an empty table
    gives an empty result.
    """
    found = find_spans(docs)
    counts = {k: F.size(k).cast("long").alias(f"n_{k}") for k in KINDS}
    base = F.array_join(F.concat(*[_listed(k) for k in KINDS[:4]]), ",")
    spans = F.array_join(F.concat(*[_listed(k) for k in KINDS]), ",")
    return found.select(
        "doc_id",
        *[counts[k] for k in KINDS[:4]],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        spans.alias("spans"),
        *[counts[k] for k in KINDS[4:]],
    )
