"""Operator 3: personal data by weak-supervision aggregation, in DataFrame operations only.

Candidates are e-mail addresses, IP addresses, card and phone numbers, which are always reported, and weaker shapes:
phone numbers without a country code, identity numbers, bank accounts and titled names. Labelers vote for, against or
not at all on each candidate: checks of its kind, a gazetteer of words in four languages that announce personal data, the
context around it and its digits. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is on
each side; the probabilities it gives to candidates then train a naive Bayes classifier of spans, which decides
about the weak ones. It sees a candidate's shape and the words around it, not the votes, so it generalises from them.

Only counts come to the driver: of vote patterns (at most 3 to the number of labelers) and of features (at most 64 values each).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import cut
from spanlink.llm.scan import scan

# A match that begins where the one before it ended may follow a character of its own class.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOCAL_PHONE = r"(?<![0-9+.(-])(?<![0-9)][\x20])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])"
PERSON = r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Mme|Mlle|Monsieur|Madame|Herr|Frau|Sr|Sra|Señora?|Doña)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?"

#: Kinds in the order of the result; the first four are base spans.
KINDS = ["email", "ip", "card", "phone", "local_phone", "identity", "account", "person"]
BASE = 4
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Words that announce personal data, and words that announce other numbers, in English, French, German and Spanish.
ANNOUNCING = [
    "account", "address", "call", "card", "cell", "contact", "e-mail", "email", "fax", "iban", "ip", "mail", "mobile", "mr", "name", "phone", "ssn", "tel", "visa",
    "adresse", "appelez", "carte", "compte", "courriel", "nom", "portable", "téléphone", "tél",
    "anruf", "handy", "karte", "kontakt", "konto", "telefon", "rufen",
    "correo", "cuenta", "dirección", "llame", "móvil", "nombre", "tarjeta", "teléfono",
]
OTHER = [
    "chapter", "figure", "id", "isbn", "line", "no", "order", "page", "part", "price", "section", "serial", "table", "v", "ver", "version",
    "article", "chapitre", "commande", "ligne", "prix", "référence", "série", "tableau",
    "artikel", "bestellung", "kapitel", "nr", "preis", "seite", "seriennummer", "tabelle", "zeile",
    "artículo", "capítulo", "línea", "pedido", "página", "precio", "serie", "tabla",
]
LABELERS = ["check", "gazetteer", "context", "border", "digits"]
ROUNDS = 30


def _digits() -> Column:
    return F.regexp_replace("text", "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the number made of digits passes the Luhn check."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c: F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)))
    total = F.aggregate(F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def valid(kind: Column) -> Column:
    """Whether a match of a kind passes the checks of its kind; a failing base match is dropped."""
    n = F.length(_digits())
    return (
        F.when(kind == 1, F.col("text").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == 2, F.when(n.between(16, 19), luhn(_digits())).otherwise(False))
        .when(kind == 3, n.between(8, 15))
        .otherwise(True)
    )


def account_check(text: Column) -> Column:
    """Whether an account number passes its check: its first four characters moved behind the rest, letters as 10 to 35, are 1 modulo 97."""
    plain = F.regexp_replace(text, r"\x20", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    values = F.transform(F.split(moved, "(?!$)"), lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v < 10, 10).otherwise(100) + v) % 97) == 1


def _said(words: list[str]) -> str:
    return r"(?<!\p{L})(?:" + "|".join(words) + ")"


def votes() -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1 for, -1 against, 0 none."""
    kind, text = F.col("kind"), F.col("text")
    last = F.lower(F.right(F.col("before"), F.lit(24)))
    announced = last.rlike(_said(ANNOUNCING) + r"(?!\p{L})")
    other = last.rlike(_said(OTHER) + r"[.:#]?[\x20]*$") | last.rlike(r"[$€£#]\x20?$")
    inside = F.col("before").rlike(r"[\p{L}\p{N}]$") | F.col("after").rlike(r"^[\p{L}\p{N}]")
    variety = F.size(F.array_distinct(F.split(_digits(), "")))

    def either(yes: Column) -> Column:
        return F.when(yes, 1).otherwise(-1)

    return {
        "check": F.when(kind == 0, either(text.rlike(r"\.[A-Za-z]{2,}$")))
        .when(kind == 1, F.when(text.rlike(r"^(?:0|127|255)\."), -1).when(text.rlike(r"[0-9]{2}"), 1).otherwise(0))
        .when(kind.isin(2, 3), 1)
        .when(kind == 4, either(text.rlike(r"^\(?[2-9]")))
        .when(kind == 5, either(~text.rlike(r"^(?:000|666|9)|-00-|-0000$")))
        .when(kind == 6, either(account_check(text)))
        .otherwise(0),
        "gazetteer": F.when(announced, 1).otherwise(0),
        "context": F.when(other, -1).when(F.col("after").rlike(r"^\x20?[%$€£°]"), -1).otherwise(0),
        "border": F.when(inside, -1).otherwise(1),
        "digits": F.when(kind.isin(0, 7), 0).when(variety >= 4, 1).when(variety <= 2, -1).otherwise(0),
    }


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Share of true candidates, and for each labeler the probability of each vote on (true, false) ones.

    patterns are votes and how often they occur. It starts from the majority of votes.
    """
    total = sum(n for _, n in patterns)
    if not total:
        return 0.5, [{v: (1 / 3, 1 / 3) for v in (-1, 0, 1)} for _ in LABELERS]
    p = [0.9 if sum(v) > 0 else 0.1 if sum(v) < 0 else 0.5 for v, _ in patterns]
    share, rates = 0.5, []
    for _ in range(rounds):
        yes = sum(n * q for (_, n), q in zip(patterns, p, strict=True))
        share = (yes + 1) / (total + 2)
        rates = []
        for j in range(len(LABELERS)):
            rate = {}
            for vote in (-1, 0, 1):
                a = sum(n * q for (v, n), q in zip(patterns, p, strict=True) if v[j] == vote)
                b = sum(n * (1 - q) for (v, n), q in zip(patterns, p, strict=True) if v[j] == vote)
                rate[vote] = (a + 1) / (yes + 3), (b + 1) / (total - yes + 3)
            rates.append(rate)
        p = [posterior(v, share, rates) for v, _ in patterns]
    return share, rates


def posterior(vote: tuple[int, ...], share: float, rates: list[dict[int, tuple[float, float]]]) -> float:
    odds = math.log(share / (1 - share)) + sum(math.log(rates[j][v][0] / rates[j][v][1]) for j, v in enumerate(vote))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def _features() -> list[tuple[Column, int]]:
    """What the span classifier sees of a candidate, each as a small integer, and how many values it can have."""
    text, before, after = F.col("text"), F.col("before"), F.col("after")
    n, kind = F.length(text), F.col("kind")
    word = F.lower(F.regexp_extract(before, r"(\p{L}+)\P{L}*$", 1))

    def side(x: Column, at: str) -> Column:
        own = [(r"\s", 1), (r"\p{L}", 2), (r"\p{N}", 3), (r"[%$€£°#]", 4), (r"[.,;:!?]", 5), (r"[()\[\]\"'«»]", 6)]
        out = F.when(x == "", 0)
        for pattern, value in own:
            out = out.when(x.rlike(at.format(pattern)), value)
        return out.otherwise(7)

    return [
        (kind, 8),
        (F.least(F.floor(n / 4), F.lit(9)).cast("int"), 10),
        (F.least(F.floor(10 * F.length(_digits()) / n), F.lit(9)).cast("int"), 10),
        (side(before, "{}$"), 8),
        (side(after, "^{}"), 8),
        (side(F.regexp_replace(after, r"^\x20", ""), "^{}"), 8),
        (F.pmod(F.hash(word), F.lit(64)), 64),
        (F.coalesce(F.ascii(F.regexp_extract(text, "[0-9]", 0)) - 47, F.lit(0)), 11),
        (F.size(F.array_distinct(F.split(_digits(), ""))), 12),
    ]


def _looked_up(weights: dict[int, float], value: Column) -> Column:
    """The weight of a value, 0 if it has none."""
    if not weights:
        return F.lit(0.0)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, w in sorted(weights.items()) for x in (k, w)]), value), F.lit(0.0))


def pii_spans(docs: DataFrame) -> DataFrame:
    """Spans of personal data in each text: rid, doc_id, spans (array of struct of kind, start, end).

    docs has doc_id and text; other columns are ignored. kind is a number of KINDS, offsets are code points, end is
    exclusive. A null text counts as empty and has no spans; a very long one is scanned whole. A row a document, so repeated rows give equal
    rows; spans that begin at the same place are all told. An empty table gives an empty result.
    """
    m = scan(docs, [EMAIL, IP, CARD, PHONE, LOCAL_PHONE, IDENTITY, ACCOUNT, PERSON])
    keep = F.col("kind").isNull() | valid(F.col("kind"))
    null_out = {c: F.when(keep, F.col(c)) for c in ("kind", "start", "end", "text", "before", "after")}
    c = cut(m.withColumns(null_out).withColumns(votes()))
    candidates = c.filter("kind is not null")

    counted = candidates.groupBy(*LABELERS).agg(F.count("*").alias("n")).collect()  # at most 3 ** 5 rows
    share, rates = expectation_maximisation([(tuple(r[x] for x in LABELERS), r.n) for r in counted])
    log_odds = F.lit(math.log(share / (1 - share)))
    for j, x in enumerate(LABELERS):
        log_odds = log_odds + _looked_up({v: math.log(a / b) for v, (a, b) in rates[j].items()}, F.col(x))
    p = 1 / (1 + F.exp(-log_odds))

    features = _features()
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), v.cast("int").alias("v")) for i, (v, _) in enumerate(features)])).alias("x")
    sums = candidates.select(p.alias("p"), pairs).groupBy("x.f", "x.v").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()  # a row a value of a feature
    yes, no = (sum(r[k] for r in sums if r.f == 0) for k in ("yes", "no"))
    score = F.lit(math.log((yes + 1) / (no + 1)))
    for i, (value, values) in enumerate(features):
        own = {r.v: math.log((r.yes + 1) / (yes + values) * (no + values) / (r.no + 1)) for r in sums if r.f == i}
        score = score + _looked_up(own, value.cast("int"))
    told = (F.col("kind") < BASE) | (score > 0)
    span = F.when(F.col("kind").isNotNull() & told, F.struct("kind", "start", "end"))
    return c.groupBy("rid", "doc_id").agg(F.collect_list(span).alias("spans"))
