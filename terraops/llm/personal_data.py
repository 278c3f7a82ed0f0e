"""Personal data in texts: regular expressions propose spans, checksums confirm them, words nearby adjust their score.

DataFrame functions alone. A pattern's matches and the gaps between them are two arrays of a row, so positions are
running totals of their lengths, and the last and first characters of the gaps are what stands around a match. Nothing
is shuffled: a row becomes a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import texts_of

#: The kinds, in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: Added spans need at least so many hundredths; a word that speaks for or against a kind is worth so many.
ACCEPTED, FOR, AGAINST = 50, 30, 40
#: Code points before and after a span in which words count, at most as far as the next match of its pattern.
BEFORE, AFTER = 48, 24
#: Running totals are made in blocks of so many lengths, so that a text with very many spans takes no square of their number.
BLOCK = 256
#: Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "XK": 20,
}
SPAN = "array<struct<start:bigint,rank:int,end:bigint,base:boolean,score:int,text:string>>"


@dataclass(frozen=True)
class Rule:
    """pattern proposes, score is what a confirmed span has; likely is a quick test that every text with a match passes."""

    kind: str
    pattern: str
    likely: str
    score: int
    words: str
    against: str = ""


# Possessive repeats and the start of a run change no match: what follows a run is never a character of it.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = Rule("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 80, "e-?mail|mail|contact|write|kontakt|courriel|correo", "noreply|placeholder")
IP = Rule("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", r"[0-9]\.[0-9]", 50, "ip|host|server|client|address|adresse", "version|release|section|chapter")
CARD = Rule("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9][0-9 -]{11}", 70, "card|credit|visa|mastercard|amex|payment|karte|carte|tarjeta", "order|invoice|isbn|serial|tracking|sku")
PHONE = Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 60, "phone|call|tel|mobile|cell|fax|telefon|telephone|movil", "order|invoice|isbn|serial|sku")
CARD_WITHIN = Rule("card", r"[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}|[0-9]{13,19}", "", 50, CARD.words, CARD.against)
PHONE_WITHIN = Rule("phone", r"^\+[0-9]{1,3}[\x20.-]?\([0-9]{1,4}\)[\x20.-]?[0-9]{2,4}[\x20.-][0-9]{2,4}|^\+[0-9]{1,3}[\x20.-]?[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}", "", 50, PHONE.words, PHONE.against)
IBAN = Rule("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", "[A-Z]{2}[0-9]{2}", 70, "iban|account|bank|konto|compte|cuenta", "sku|serial")
SSN = Rule("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]-[0-9]{2}-[0-9]", 20, "ssn|social security", "order|invoice|part|serial")


def running_totals(values: Column) -> Column:
    """The sum of all values before each, in order; work grows with the number of values times BLOCK, not its square."""
    none = F.array().cast("array<bigint>")
    add = lambda state, v: F.struct((state.t + v).alias("t"), F.concat(state.before, F.array(state.t)).alias("before"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda k: F.slice(values, k * BLOCK + 1, BLOCK))
    blocks = F.when(F.size(values) > BLOCK, blocks).otherwise(F.array(values))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda t, v: t + v))
    starts = F.aggregate(sums, F.struct(F.lit(0).cast("bigint").alias("t"), none.alias("before")), add)["before"]
    return F.flatten(F.zip_with(blocks, starts, lambda b, t: F.aggregate(b, F.struct(t.alias("t"), none.alias("before")), add)["before"]))


def located(df: DataFrame, patterns: dict[str, tuple[Column, str]]) -> DataFrame:
    """df with a column array<struct<start,text,last,first>> for each name of patterns: the matches of a pattern in pieces.

    patterns has the pieces, array<struct<start,text,last,first>>, parts of one text in order, and the pattern. last
    and first are the code points before and after a match, or those of its piece where the piece ends.
    """
    gap = lambda g: F.struct(F.char_length(g).cast("bigint").alias("n"), F.right(g, F.lit(BEFORE)).alias("last"), F.left(g, F.lit(AFTER)).alias("first"))
    step = lambda f, g: F.coalesce(F.char_length(f), F.lit(0)) + g.n

    def matched(pattern: str):
        return lambda p: F.struct(p.start.alias("start"), p["last"].alias("last"), p["first"].alias("first"), F.regexp_extract_all(p.text, F.lit(pattern), F.lit(0)).alias("found"), F.transform(F.split(p.text, pattern, -1), gap).alias("gaps"))

    def spans(p: Column) -> Column:
        def span(f: Column, k: Column) -> Column:
            before, after = p.gaps[k], p.gaps[k + 1]
            last = F.when(k == 0, F.right(F.concat(p["last"], before["last"]), F.lit(BEFORE))).otherwise(before["last"])
            first = F.when(k == F.size(p.found) - 1, F.left(F.concat(after["first"], p["first"]), F.lit(AFTER))).otherwise(after["first"])
            return F.struct((p.start + p.before[k] + before.n).alias("start"), f.alias("text"), last.alias("last"), first.alias("first"))

        return F.transform(p.found, span)

    df = df.withColumns({name: F.transform(pieces, matched(pattern)) for name, (pieces, pattern) in patterns.items()})
    df = df.withColumns({name: F.transform(F.filter(name, lambda p: F.size(p.found) > 0), lambda p: p.withField("steps", F.zip_with(p.found, p.gaps, step))) for name in patterns})
    df = df.withColumns({name: F.transform(name, lambda p: p.withField("before", running_totals(p.steps))) for name in patterns})
    return df.withColumns({name: F.flatten(F.transform(name, spans)) for name in patterns})


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(text: Column, least: int, most: int) -> Column:
    """Whether the digits of text are so many and pass the check."""
    digits = digits_of(text)
    return F.when(F.length(digits).between(least, most), F.call_function("luhn_check", digits)).otherwise(False)


def passes_97(text: Column) -> Column:
    """Whether an account number's letters and digits, the first four put last and letters read as 10 to 35, are 1 modulo 97."""
    code = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    value = lambda ch: F.when(ch.between("0", "9"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda r, ch: (r * F.when(ch.between("0", "9"), 10).otherwise(100) + value(ch)) % 97)
    return rest == 1


def _near(rule: Rule, last: Column, first: Column) -> Column:
    """The score of a confirmed span in its surroundings."""
    around = F.lower(F.concat(last, F.lit("\n"), first))
    held = lambda words: around.rlike(f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")
    score = F.lit(rule.score) + F.when(held(rule.words), FOR).otherwise(0)
    if rule.against:
        score = score - F.when(held(rule.against), AGAINST).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int")


def _spans(rule: Rule, matches: Column, base: bool) -> Column:
    def span(m: Column) -> Column:
        end = m.start + F.char_length(m.text)
        return F.struct(m.start.alias("start"), F.lit(KINDS.index(rule.kind)).cast("int").alias("rank"), end.cast("bigint").alias("end"), F.lit(base).alias("base"), _near(rule, m["last"], m["first"]).alias("score"), m.text.alias("text"))

    found = F.transform(matches, span)
    return found if base else F.filter(found, lambda s: s.score >= ACCEPTED)


def _own_account(m: Column) -> Column:
    """m cut to the length of its country's account numbers; its text is null if there is no such length, or if it goes on."""
    n = F.element_at(F.create_map(*[F.lit(v) for pair in IBAN_LENGTHS.items() for v in pair]), F.substring(m.text, 1, 2))
    cut = F.coalesce(F.regexp_substr(m.text, F.concat(F.lit(r"^(?:[A-Z0-9]\x20?){"), (n - 1).cast("string"), F.lit("}[A-Z0-9]"))), F.lit(""))
    rest = F.concat(F.substring(m.text, F.char_length(cut) + 1, F.char_length(m.text)), m["first"])
    whole = n.isNotNull() & (cut != "") & ~m["last"].rlike(r"[A-Za-z0-9]\z") & ~rest.rlike("^[A-Za-z0-9]")
    return m.withField("text", F.when(whole, cut))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of each row of docs: array<struct<kind,start,end,base,score,text>> by start, then kind as in KINDS.

    start and end are code points of the whole text, end exclusive; score is in hundredths. Base spans (base is true)
    are the leftmost non-overlapping matches of email, ip, card and phone that pass their test, whatever their score:
    parts of an address at most 255, 14 to 19 digits that pass Luhn's check, 10 to 15 digits. Added ones come from
    what failed: cards of 13 to 19 digits within longer runs, in one piece or in groups, and phone numbers at the
    start of longer ones; and from account numbers (mod 97, the length of their country) and social security numbers,
    which have no check and need a word nearby. They count from a score of ACCEPTED.

    A null text is empty, and an empty text has no spans. Rows with null or repeated ids give a row each; other columns
    are ignored; an empty table gives no rows. A text is worked on in one task, in time and memory that grow with
    its length (some ten times its bytes), runs of one character class among them.
    """
    df = texts_of(docs)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("text").alias("text"), F.lit("").alias("last"), F.lit("").alias("first")))
    likely = lambda rule: F.col("text").contains(rule.likely) if rule.likely == "@" else F.col("text").rlike(rule.likely)
    df = located(df, {rule.kind: (F.when(likely(rule), whole).otherwise(F.slice(whole, 1, 0)), rule.pattern) for rule in (EMAIL, IP, CARD, PHONE, IBAN, SSN)})
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    passes = {
        "ip": lambda m: m.text.rlike(rf"^{part}\.{part}\.{part}\.{part}$"),
        "card": lambda m: passes_luhn(m.text, 14, 19),
        "phone": lambda m: F.length(digits_of(m.text)).between(10, 15),
        "ssn": lambda m: ~m["last"].rlike(r"[0-9-]\z") & ~m["first"].rlike("^[0-9-]") & ~m.text.rlike("^(?:000|666|9)|-00-|-0000$"),
    }
    df = df.withColumn("iban", F.filter(F.transform("iban", _own_account), lambda m: m.text.isNotNull()))
    passes["iban"] = lambda m: passes_97(m.text)
    # ok holds which matches pass, so that each is tested once
    kinds = list(passes)
    tested = lambda test: lambda m: m.withField("ok", test(m))
    df = df.withColumns({k: F.transform(k, tested(passes[k])) for k in kinds})
    failed = lambda k, least: F.filter(k, lambda m: ~m.ok & (F.char_length(m.text) >= least))
    df = located(df, {"__card": (failed("card", 13), CARD_WITHIN.pattern), "__phone": (failed("phone", 10), PHONE_WITHIN.pattern)})
    apart = lambda m: ~m["last"].rlike(r"[0-9]\z") & ~m["first"].rlike("^[0-9]")
    fine = {"__card": lambda m: apart(m) & passes_luhn(m.text, 13, 19), "__phone": lambda m: apart(m) & F.length(digits_of(m.text)).between(10, 15)}
    sound = {k: F.filter(k, lambda m: m.ok) for k in kinds}
    parts = [_spans(EMAIL, F.col("email"), True), _spans(IP, sound["ip"], True), _spans(CARD, sound["card"], True), _spans(PHONE, sound["phone"], True), _spans(IBAN, sound["iban"], False), _spans(SSN, sound["ssn"], False)]
    parts += [_spans(rule, F.filter(k, fine[k]), False) for k, rule in (("__card", CARD_WITHIN), ("__phone", PHONE_WITHIN))]
    spans = F.sort_array(F.concat(*[p.cast(SPAN) for p in parts]))
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(spans, lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s.start.alias("start"), s.end.alias("end"), s.base.alias("base"), s.score.alias("score"), s.text.alias("text")))
    return df.select("doc_id", shown.alias("spans"))


def span_digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of what personal_data gives.

    spans are kind:start:end joined by commas, scores likewise in their order; the counts and base_sha256 are of base spans.
    """
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = found.select("doc_id", "spans", F.filter("spans", lambda s: s.base).alias("base"))
    of = lambda kind: lambda s: s.kind == kind
    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    scores = F.array_join(F.transform("spans", lambda s: s.score.cast("string")), ",")
    return base.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), scores.alias("scores"))
