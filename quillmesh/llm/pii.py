"""Personal data by weak supervision (operator 3).

Four kinds are defined by rule (email, ip, card, phone) and are always kept. Beyond these, candidates of six
kinds come from wide patterns: email (written out), phone (without a plus), card (no check sum), secret, iban and name.
Labelers vote on each candidate: regular expressions for its form, gazetteers of titles, given names and key words, and
its context. A labeler says yes, no or nothing. Expectation-maximisation over the counts of vote patterns estimates
each labeler's reliability per kind and the chance that a candidate is real (a Dawid-Skene model); the pattern table
has a fixed number of rows, whatever the corpus. With those posteriors a logistic span classifier over votes, shape and
length is trained, and a candidate is kept if the classifier says so and no base span overlaps it.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import map_batches, numbered_columns, stored, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "iban", "name")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """At each @ the local part is all that may stand before it since the last match, so the scan stays linear."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        low = max(done, at - 1)
        while low >= done and low < at and (text[low].isascii() and (text[low].isalnum() or text[low] in "._%+-")):
            low -= 1
        low += 1
        if low < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((low, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return found


def _addresses(text: str) -> list[tuple[int, int]]:
    """A maximal run of dotted numbers gives matches of four numbers each, from its front."""
    found = []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            numbers, start = m[0].split("."), m.start()
            for k in range(0, len(numbers) - 3, 4):
                four = numbers[k : k + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in four):
                    found.append((start, end))
                start = end + 1
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four kinds by rule, ordered by start, then kind; each kind is matched on its own,
    leftmost first, and a match that fails its test is dropped without another try."""
    spans = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    spans += [(a, b, "ip") for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            spans.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], BASE.index(s[2])))


#: Wide patterns of candidates: what a labeler may then speak for or against. A secret is a whole run of its alphabet,
#: however long; the others have bounded repeats.
CANDIDATES = [
    ("email", re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._-]{0,63} ?[\[(]? ?(?:at|AT) ?[\])]? ?[A-Za-z0-9-]{1,63}(?: ?[\[(]? ?(?:dot|DOT) ?[\])]? ?[A-Za-z]{2,24}){1,3}\b")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", re.compile(r"(?<![0-9A-Za-z.+-])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9A-Za-z-])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])")),
    ("name", re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora|Sr|Sra)\.? [A-ZÀ-Þ][a-zß-ÿ'-]{1,40}(?: [A-ZÀ-Þ][a-zß-ÿ'-]{1,40})?")),
]
#: What a candidate of the pattern can't do without; the pattern is only tried where it occurs.
_HINTS = {"email": re.compile(r"(?:dot|DOT)\b"), "phone": re.compile(r"[0-9]{3}"), "card": re.compile(r"[0-9]{4}"), "secret": re.compile(r"[0-9]"), "iban": re.compile(r"[A-Z]{2}[0-9]{2}"), "name": re.compile(r"(?:M[rs]|Dr|Prof|Herr|Frau|Madame|Monsieur|Se.or|Sr)")}

#: Gazetteers: words before a candidate that speak for a kind, and given names.
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "correo", "courriel"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "secret": ("token", "key", "secret", "password", "passwd", "api", "bearer", "auth"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "name": ("name", "signed", "dear", "from", "contact", "patient"),
}
GIVEN = frozenset(
    "james john robert michael william david mary patricia jennifer linda elizabeth susan sarah karen nancy lisa daniel mark steven andrew george edward brian kevin laura emily emma "
    "olivia grace alice helen ruth anna maria peter paul thomas martin stefan hans karl heinz klaus jürgen wolfgang dieter uwe ursula monika petra sabine claudia katrin julia lena "
    "jean pierre michel philippe jacques françois louis claude marie sophie isabelle nathalie camille chloé hélène jose josé juan carlos luis miguel antonio manuel francisco jesús "
    "pedro pablo carmen pilar lucía rosa elena marta cristina ana giovanni marco luca paolo giulia francesca ivan sergei dmitri olga natalia tatiana piotr jan katarzyna agnieszka "
    "ahmed mohammed ali fatima omar yusuf wei li ming hiroshi yuki kenji min-jun priya arjun raj".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_DIGIT = re.compile(r"[0-9]")


def _iban_ok(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _form(kind: str, found: str) -> int:
    """The strict form: 1, -1 or 0."""
    if kind == "email":
        return 1 if re.search(r"[\[(]", found) else -1 if found.count(" ") < 4 else 0
    if kind == "phone":
        return 1 if len(_NOT_DIGIT.sub("", found)) == 10 and found.lstrip("(")[0] in "23456789" else -1
    if kind == "card":
        return 1 if luhn(_NOT_DIGIT.sub("", found)) else -1
    if kind == "iban":
        return 1 if _iban_ok(found) else -1
    if kind == "secret":
        path = "/" in found and max(map(len, found.split("/"))) < 20
        return 1 if re.fullmatch(r"[0-9a-f]{32,}|[0-9A-F]{32,}", found) else -1 if path or found.isdigit() or found.count("-") > 6 else 0
    return 1 if found.count(" ") == 2 else 0


def _gazetteer(kind: str, found: str, before: str) -> int:
    words = {w.lower() for w in _WORD.findall(before)}
    if kind == "name" and any(w.lower() in GIVEN for w in _WORD.findall(found)):
        return 1
    return 1 if words & set(CUES[kind]) else 0


def _context(kind: str, before: str, after: str) -> int:
    """Assignment and list marks speak for data, running markup and formulas against it."""
    tail = before.rstrip(" \"'")
    if tail.endswith(("=", ":", "#")) or before.endswith(('"', "'")):
        return 1
    return -1 if tail.endswith(("/", "$", "*", "^")) or after[:1] in ("/", "%", "*") else 0


def _variety(kind: str, found: str) -> int:
    """Filler (one or two characters again and again) is no personal datum; mixed characters are."""
    kinds = len(set(found))
    return -1 if kinds <= 4 else 1 if kinds >= 8 else 0


LABELERS = ("form", "gazetteer", "context", "variety")


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(start, end, kind, votes) of candidates that no base span overlaps, and that no earlier candidate does."""
    found, taken = [], [(a, b) for a, b, _ in base]
    taken.sort()
    for kind, pattern in CANDIDATES:
        if not _HINTS[kind].search(text):
            continue
        for m in pattern.finditer(text):
            if kind == "secret" and not _DIGIT.search(m[0]):
                continue
            a, b = m.span()
            k = bisect_left(taken, (a, b))
            if any(x < b and a < y for x, y in taken[max(0, k - 1) : k + 1]):
                continue
            taken.insert(k, (a, b))
            before, after = text[max(0, a - 24) : a], text[b : b + 8]
            found.append((a, b, kind, (_form(kind, m[0]), _gazetteer(kind, m[0], before), _context(kind, before, after), _variety(kind, m[0]))))
    return sorted(found)


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[str, tuple[int, ...]], float]:
    """Dawid-Skene by expectation-maximisation over (kind, votes, count): the chance that such a candidate is real.
    Starting reliabilities say that a labeler's yes and no are each right four times in five; pseudo-counts keep kinds
    with few candidates near them."""
    out = {}
    for kind in {p[0] for p in patterns}:
        mine = [(v, n) for k, v, n in patterns if k == kind]
        votes, n = np.array([v for v, _ in mine]), np.array([n for _, n in mine], float)
        one_hot = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
        start = {True: np.array([0.1, 0.5, 0.4]), False: np.array([0.4, 0.5, 0.1])}
        table = {z: np.tile(start[z], (votes.shape[1], 1)) for z in (True, False)}
        share = 0.5
        for _ in range(rounds):
            log = {z: np.einsum("plv,lv->p", one_hot, np.log(table[z])) for z in table}
            real = 1 / (1 + np.exp(np.clip(np.log(1 - share) + log[False] - np.log(share) - log[True], -50, 50)))
            share = float(np.clip(((real * n).sum() + 5) / (n.sum() + 10), 0.02, 0.98))
            for z, weight in ((True, real * n), (False, (1 - real) * n)):
                counts = np.einsum("p,plv->lv", weight, one_hot) + 20 * start[z]
                table[z] = counts / counts.sum(1, keepdims=True)
        out |= {(kind, v): float(p) for (v, _), p in zip(mine, real)}
    return out


def _features(kind: str, votes: tuple[int, ...], size: int) -> list[float]:
    return [1.0, *votes, *(abs(v) for v in votes), min(size, 64) / 64, *(kind == k for k in KINDS)]


def train_classifier(patterns: list[tuple[str, tuple[int, ...], int, int]], truth: dict) -> np.ndarray:
    """Logistic regression on (kind, votes, length class, count), each row counted with its posterior."""
    x = np.array([_features(k, v, 8 * s) for k, v, s, _ in patterns])
    n, p = np.array([r[3] for r in patterns], float), np.array([truth[k, v] for k, v, _, _ in patterns])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(len(w)), x.T @ (n * (p - q)) - 0.5 * w)
    return w


def find_personal_data(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, found): base and found (all spans) are arrays of (start, stop, kind) in code points. A null text is
    empty and has no spans; null ids and repeated rows give a row each; other columns are dropped; an empty table gives
    no rows."""
    found = _spans(docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1")), "c1", ["c0"], threshold)
    return found.select(F.col("c0").alias(id_col), "base", "found")


def _spans(docs: DataFrame, text_col: str, names: list[str], threshold: float = 0.5) -> DataFrame:
    """The named columns of docs, whose columns are called c0, c1 and so on, with base and found."""
    span = "struct<start:int,stop:int,kind:string"
    given = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names)
    columns = docs.columns
    place = columns.index(text_col)

    def scan(batches):
        for b in batches:
            base, more = [], []
            for text in texts_of(b.column(place)):
                spans = base_spans(text)
                base.append([{"start": s, "stop": e, "kind": k} for s, e, k in spans])
                more.append([{"start": s, "stop": e, "kind": k, "votes": list(v)} for s, e, k, v in candidates(text, spans)])
            yield {c: b.column(columns.index(c)) for c in names} | {"base": base, "more": more}

    scanned = stored(map_batches(docs, scan, f"{given}, base array<{span}>>, more array<{span},votes:array<int>>>"), "pii-spans")
    # a bounded table: kinds x 3^labelers vote patterns x 9 length classes
    found = scanned.select(F.explode("more").alias("m")).groupBy("m.kind", "m.votes", F.least(F.floor((F.col("m.stop") - F.col("m.start")) / 8), F.lit(8)).alias("size")).count()
    patterns = sorted((r["kind"], tuple(r["votes"]), int(r["size"]), int(r["count"])) for r in found.collect())
    if patterns:
        totals: dict = {}
        for k, v, _, n in patterns:
            totals[k, v] = totals.get((k, v), 0) + n
        w = train_classifier(patterns, estimate([(k, v, n) for (k, v), n in sorted(totals.items())]))
        weight = float(np.log(threshold / (1 - threshold)))

        def accepted(m):
            votes = [m["votes"][k] for k in range(len(LABELERS))]
            size = F.least(F.floor((m["stop"] - m["start"]) / 8) * 8, F.lit(64)) / 64
            z = F.lit(float(w[0])) + size * float(w[1 + 2 * len(LABELERS)])
            for k, v in enumerate(votes):
                z = z + v * float(w[1 + k]) + F.abs(v) * float(w[1 + len(LABELERS) + k])
            for k, kind in enumerate(KINDS):
                z = z + F.when(m["kind"] == kind, float(w[2 + 2 * len(LABELERS) + k])).otherwise(0.0)
            return z >= weight
    else:
        accepted = lambda m: F.lit(False)
    plain = F.transform(F.filter("more", accepted), lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), m["kind"].alias("kind")))
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.transform(F.concat("base", plain), lambda s: F.struct(s["start"], F.array_position(order, s["kind"]).alias("rank"), s["stop"], s["kind"]))
    spans = F.transform(F.array_sort(ranked), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    return scanned.select(*names, "base", spans.alias("found"))


def digest(spans: str):
    """kind:start:end by start, then kind as listed, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span (merged where they overlap, under the first one's kind) replaced by [KIND]."""
    out, at = [], 0
    for start, stop, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with its columns, whatever their names, personal data replaced in the text (a null text stays null) and
    n_chars, if there, counted anew. Null ids and repeated rows stay."""
    own = numbered_columns(docs)
    names, lower = own.columns, [c.lower() for c in docs.columns]
    text = names[lower.index(text_col.lower())]
    chars = names[lower.index("n_chars")] if "n_chars" in lower else None
    given = ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        for b in batches:
            columns = {c: b.column(i) for i, c in enumerate(names)}
            texts = [
                t if t is None else redact(t, [(s["start"], s["stop"], s["kind"]) for s in spans])
                for t, spans in zip(columns[text].to_pylist(), b.column(len(names)).to_pylist())
            ]
            columns[text] = texts
            if chars:
                columns[chars] = [n if t is None else len(t) for n, t in zip(columns[chars].to_pylist(), texts)]
            yield columns

    return map_batches(_spans(own, text, names).select(*names, "found"), run, given).toDF(*docs.columns)
