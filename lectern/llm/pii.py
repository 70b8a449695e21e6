"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Patterns give candidate spans: the base kinds (email, ip, card, phone), which always stay, and
looser ones (``mail``: spelled-out addresses, ``tel``: national numbers, ``ssn``: social security
numbers, ``name``: persons by title, ``street``: house and street), which must be found likely.  Three labelers vote on every candidate, for, against or not at all: a regex labeler on
its strict form, a gazetteer labeler on known names and ranges, a context labeler on the words
around it.  Expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is and how likely each pattern is personal data.  These probabilities are the labels on
which a logistic span classifier over kind, votes and surroundings is trained.

Documents are touched by DataFrame operations only.  The driver gets the counts of distinct
feature combinations, whose number is bounded by the features (see ``COMBINATIONS``), not by rows.

Defined results: a null text has no spans; repeated rows are scanned each; null ids are kept; an
empty table gives an empty result; without loose candidates the classifier decides nothing; other
columns are kept by :func:`redact` and ignored otherwise.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import materialize, pick, shielded
from lectern.llm.spans import bound, clear_of, matches, replaced, written

LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++"
IP = r"[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
AT, DOT = r"\x20?[\[(]\x20?at\x20?[\])]\x20?", r"(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\.)"
MAIL = rf"(?<![{LOCAL}])[{LOCAL}]++{AT}[A-Za-z0-9-]++{DOT}[A-Za-z]{{2,}}+"
TEL = r"(?<![0-9+(.-])(?<![0-9)]\x20)[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
TITLE = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Mlle|Sr|Sra|Señor|Señora"
NAME = rf"(?=[MDPHFS])(?<!\p{{L}})(?:{TITLE})\.?\x20\p{{Lu}}\p{{Ll}}++(?:\x20\p{{Lu}}\p{{Ll}}++)?"
WAY = "Street|Avenue|Road|Boulevard|Lane|Drive|Court|Square|St|Ave|Rd|Blvd|Ln|Ct"
STREET = rf"(?<![0-9A-Za-z])[0-9]{{1,5}}[A-Za-z]?\x20(?:\p{{Lu}}\p{{Ll}}++\x20){{1,3}}(?:{WAY})(?!\p{{L}})"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

KINDS = ["email", "ip", "card", "phone", "mail", "tel", "ssn", "name", "street"]
BASE = KINDS[:4]
SIDES = ["none", "space", "letter", "digit", "other"]
#: kinds x votes of three labelers x both sides
COMBINATIONS = len(KINDS) * 27 * len(SIDES) ** 2

# Gazetteers of public facts.
TOP_LEVEL = "com|org|net|edu|gov|mil|int|info|biz|io|co|me|dev|app|eu|uk|de|fr|es|it|nl|be|at|ch|se|no|dk|fi|pl|pt|ie|us|ca|mx|br|ar|cl|jp|cn|in|kr|au|nz|za|ru|tr|gr|cz|hu|ro"
CALLING = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|81|82|84|86|90|91|92|93|94|95|98|2[0-9]{2}|3[578][0-9]|42[0-9]|5[09][0-9]|6[789][0-9]|85[0-9]|88[0-9]|9[679][0-9]"
RESERVED = r"0|10|127|2[2-5][0-9]"
CUES = {
    "email": "e-?mail|contact|write|courriel|correo|kontakt",
    "ip": r"\bip\b|address|host|server|login|adresse|direcci",
    "card": "card|visa|master|credit|payment|carte|karte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telef|appel",
}
CUES |= {"mail": CUES["email"], "tel": CUES["phone"], "ssn": "ssn|social security|national id", "name": "dear|signed|sincerely|patient|born|contact|regards", "street": "address|live|located|ship|visit|deliver|zip"}
GIVEN = "James|Mary|John|Maria|Jane|Anna|Peter|Paul|Robert|Linda|Michael|Sarah|David|Laura|Thomas|Jean|Marie|Pierre|Juan|Carlos|Hans|Karl"
ROADS = "Main|Park|Oak|High|Church|Elm|Maple|Cedar|Washington|Lake|Hill|Station|King|Queen|Victoria|Mill"
AGAINST = {"ssn": "isbn|part|model|order", "street": "version|chapter","ip": "version|release|section", "card": "isbn|order|serial|invoice", "phone": "score|sum"}


def digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    """The checksum holds for a string of digits."""
    n = F.length(t)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(t, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)


def _of_kind(s: Column, cases: dict[str, Column], otherwise: Column | None = None) -> Column:
    out = F
    for kind, value in cases.items():
        out = out.when(s["kind"] == kind, value)
    return out.otherwise(otherwise) if otherwise is not None else out


def _strict(s: Column) -> Column:
    t = s["text"]
    return _of_kind(s, {
        "email": t.rlike(r"\.[A-Za-z]{2,24}$"),
        "ip": ~t.rlike(r"(?:^|\.)0[0-9]"),
        "card": ~t.rlike("[ -]") | t.rlike("^[0-9]{4}(?:[ -][0-9]{4}){3}"),
        "phone": F.length(digits(t)).between(10, 13),
        "mail": t.rlike(r"[\])]\x20?[A-Za-z]{2,24}$|\.[A-Za-z]{2,24}$"),
        "tel": t.rlike(r"^[(][0-9]{3}[)]|^[0-9]{3}([.-])[0-9]{3}\1"),
        "ssn": ~t.rlike("^(?:000|666|9)|-00-|-0000$"),
        "name": t.rlike(r"\x20\p{Lu}\p{Ll}+\x20\p{Lu}"),
        "street": t.rlike("(?:Street|Avenue|Road|Boulevard|Lane|Drive|Court|Square)$"),
    })


def _listed(s: Column) -> Column:
    t = s["text"]
    return _of_kind(s, {
        "email": t.rlike(rf"(?i)\.(?:{TOP_LEVEL})$"),
        "ip": ~t.rlike(rf"^(?:{RESERVED})\.|^192\.168\."),
        "card": t.rlike("^[3-6]"),
        "phone": digits(t).rlike(f"^(?:{CALLING})"),
        "mail": t.rlike(rf"(?i)[^A-Za-z](?:{TOP_LEVEL})$"),
        "tel": t.rlike("^[(]?[2-9]"),
        "ssn": t.rlike("^[0-7]"),
        "name": t.rlike(rf"\x20(?:{GIVEN})(?:\x20|$)"),
        "street": t.rlike(rf"\x20(?:{ROADS})\x20"),
    })


def _context(s: Column) -> Column:
    near = F.lower(F.concat_ws("\n", s["before"], s["after"]))
    return F.when(_of_kind(s, {k: near.rlike(v) for k, v in CUES.items()}), 1).when(_of_kind(s, {k: near.rlike(v) for k, v in AGAINST.items()}), 0).otherwise(-1)


def _side(c: Column) -> Column:
    return F.when(c == "", "none").when(c.rlike("^[\\x20\\x09-\\x0D]"), "space").when(c.rlike(r"^\p{L}"), "letter").when(c.rlike("^[0-9]"), "digit").otherwise("other")


def candidates(text: Column) -> Column:
    """Structs kind, rank, start, end, votes and sides: base kinds first, then loose ones that overlap no base one."""
    patterns = [
        ("email", EMAIL, "@[A-Za-z0-9-]"),
        ("ip", IP, r"[0-9]\.[0-9]"),
        ("card", CARD, r"[0-9](?:[\x20-]?[0-9]){15}"),
        ("phone", PHONE, r"\+[0-9]"),
        ("mail", MAIL, r"[\[(]\x20?at\x20?[\])]"),
        ("tel", TEL, r"[0-9]{3}[\x20.-][0-9]{4}"),
        ("ssn", SSN, "[0-9]-[0-9]{2}-[0-9]"),
        ("name", NAME, NAME),
        ("street", STREET, rf"[0-9][A-Za-z]?\x20\p{{Lu}}.{{0,80}}(?:{WAY})"),
    ]
    long_enough = lambda s, low, high: F.length(digits(s["text"])).between(low, high)
    valid = lambda s: _of_kind(s, {"ip": s["text"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"), "card": long_enough(s, 16, 19) & luhn(digits(s["text"])), "phone": long_enough(s, 8, 15)}, F.lit(True))

    def voted(s: Column) -> Column:
        votes = {"regex": _strict(s), "gazetteer": _listed(s), "context": _context(s)}
        sides = {"left": _side(F.right(s["before"], F.lit(1))), "right": _side(F.left(s["after"], F.lit(1)))}
        return F.struct(*(s[c].alias(c) for c in ("kind", "rank", "start", "end")), *(v.cast("int").alias(k) for k, v in votes.items()), *(v.alias(k) for k, v in sides.items()))

    found = F.transform(F.filter(matches(text, patterns), valid), voted)
    return bound(found, lambda x: bound(F.filter(x, lambda s: s["rank"] < len(BASE)), lambda base: F.concat(base, clear_of(F.filter(x, lambda s: s["rank"] >= len(BASE)), base))))


def em(kinds: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each pattern being personal data, and each labeler's vote rates by class.

    ``votes`` holds 1, 0 or -1 (none) by pattern and labeler; ``n`` is how often a pattern occurs.
    """
    base = np.isin(kinds, [KINDS.index(k) for k in BASE])
    p = np.where(base, 0.9, 0.5) * 0.5 + 0.25 * (1 + np.sign(np.where(votes < 0, 0, 2 * votes - 1).sum(axis=1))) * 0.9 + 0.02
    rates = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack((n * (1 - p), n * p))
        prior = {k: (weight[1, kinds == k].sum() + 1) / (n[kinds == k].sum() + 2) for k in np.unique(kinds)}
        for j in range(votes.shape[1]):
            for v in (-1, 0, 1):
                rates[j, :, v] = weight[:, votes[:, j] == v].sum(axis=1) + 1
        rates /= rates.sum(axis=2, keepdims=True)
        log = np.log(np.array([[1 - prior[k], prior[k]] for k in kinds]))
        for j in range(votes.shape[1]):
            log += np.log(rates[j][:, votes[:, j]]).T
        p = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -35, 35)))
    return p, rates


FEATURES = {"kind": KINDS, "regex": [0, 1], "gazetteer": [0, 1], "context": [-1, 0, 1], "left": SIDES, "right": SIDES}


def train(scanned: DataFrame) -> dict[tuple[str, object], float]:
    """Weights of the span classifier by feature value; ("", None) is the intercept."""
    each = scanned.select(F.inline("spans"))
    rows = each.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n")).collect()  # at most COMBINATIONS rows
    values = [(f, v) for f, vs in FEATURES.items() for v in vs]
    if not rows:
        return {("", None): 0.0} | dict.fromkeys(values, 0.0)
    rows.sort(key=lambda r: tuple(str(r[f]) for f in FEATURES))
    kinds = np.array([KINDS.index(r["kind"]) for r in rows])
    votes = np.array([[r["regex"], r["gazetteer"], r["context"]] for r in rows])
    n = np.array([float(r["n"]) for r in rows])
    p, _ = em(kinds, votes, n)
    x = np.array([[1.0, *(float(r[f] == v) for f, v in values)] for r in rows])
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps on the weighted log loss with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + np.eye(len(w)), x.T @ (n * (p - q)) - w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {("", None): float(w[0])} | {v: float(c) for v, c in zip(values, w[1:])}


def detect(docs: DataFrame, *, text_col: str = "text", keep: list[str], at_least: float = 0.5) -> DataFrame:
    """``keep`` columns and ``spans`` of kind, rank, start, end and probability, in text order."""
    scanned = materialize(pick(docs, *keep, text_col).select(*keep, candidates(F.coalesce(F.col(text_col), F.lit(""))).alias("spans")), "pii")
    weights = train(scanned)
    tables = {f: F.create_map(*(x for v in vs for x in (F.lit(v), F.lit(weights[f, v])))) for f, vs in FEATURES.items()}

    def judged(s: Column) -> Column:
        z = F.lit(weights["", None])
        for f, table in tables.items():
            z = z + F.element_at(table, s[f])
        return F.struct(s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), (1 / (1 + F.exp(-z))).alias("probability"))

    kept = F.filter(F.transform("spans", judged), lambda s: (s["rank"] < len(BASE)) | (s["probability"] >= at_least))
    return scanned.withColumn("spans", kept)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and spans; ``probabilities`` has the classifier's verdict on each of ``spans``, in their order, ``n_likely`` how many it finds likely."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    in_order = F.array_sort(F.transform("spans", lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["probability"].alias("p"))))
    told = F.array_join(F.transform(in_order, lambda s: F.format_string("%.4f", s["p"])), ",")
    return found.select(
        id_col,
        *(number(k).alias(f"n_{k}") for k in BASE),
        F.sha2(written(base, "rank", "start"), 256).alias("base_sha256"),
        written(F.col("spans"), "rank", "start").alias("spans"),
        told.alias("probabilities"),
        F.size(F.filter("spans", lambda s: s["probability"] >= 0.5)).cast("long").alias("n_likely"),
    )


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first names the whole."""
    return shielded(docs, [text_col, "n_chars"], lambda d: _redacted(d, text_col))


def _redacted(docs: DataFrame, text_col: str) -> DataFrame:
    found = detect(docs, text_col=text_col, keep=docs.columns)
    text = F.col(text_col)
    clean = replaced(text, F.col("spans"), lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    changed = {text_col: F.when(F.size("spans") > 0, clean).otherwise(text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length(clean)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumns(changed).select(*docs.columns)
