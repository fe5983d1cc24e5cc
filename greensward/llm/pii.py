"""Personal data: Aho-Corasick anchors, expanded and validated by local parsers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greensward.llm.memory import text_batches

#: Kinds in the order in which spans are listed; the first four are the contract's base.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret")

#: Anchors: the at-sign, the plus of phone numbers, digits, schemes, and cues before or at the start of identifiers, in any letter case.
SCHEMES = ("http://", "https://", "ftp://")
IDENTIFIERS = ("iban", "ssn", "account", "acct", "passport", "userid", "user_id", "konto", "compte", "cuenta")
SECRETS = ("password", "passwd", "passphrase", "pwd", "secret", "api_key", "api-key", "apikey", "access_key", "private_key", "token", "bearer", "passwort", "mot de passe", "contraseña")
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "sk-")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT, _DIGITS = re.compile(r"[0-9]"), re.compile(r"[0-9]+")
_URL_HOST = re.compile(r"(?:[^\s/?#@]*@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?=[/?#\s]|\W|$)")
_URL_REST = re.compile(r"[^\s<>\"']*")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_AFTER_ID = re.compile(r"(?:\s*(?:no|nr|number|id)\.?)?\s*[:=#]?\s*", re.I)
_ID = re.compile(r"[A-Z0-9][A-Z0-9-]{4,33}")
_AFTER_SECRET = re.compile(r"[\"']?\s*(?:[:=]|=>)\s*[\"']?([^\s\"',;]{6,})|(?<=[Bb]earer)\s+([A-Za-z0-9._~+/-]{16,}=*)")
_KEY = {"AKIA": re.compile(r"AKIA[A-Z0-9]{16}\b"), "ASIA": re.compile(r"ASIA[A-Z0-9]{16}\b"), "ghp_": re.compile(r"ghp_[A-Za-z0-9]{36}\b"), "sk-": re.compile(r"sk-[A-Za-z0-9]{20,}\b")}

Span = tuple[str, int, int]


def _automaton() -> ahocorasick.Automaton:
    """Over lower-cased text, so that cues are met in any letter case."""
    a = ahocorasick.Automaton()
    for c, kind in [("@", "at"), ("+", "plus")] + [(d, "digit") for d in "0123456789"]:
        a.add_word(c, (kind, 1))
    for kind, words in (("scheme", SCHEMES), ("id", IDENTIFIERS), ("secret", SECRETS)):
        for w in words:
            a.add_word(w, (kind, len(w)))
    for w in KEY_PREFIXES:
        a.add_word(w.lower(), (w, len(w)))
    a.make_automaton()
    return a


def lowered(text: str) -> str:
    """Lower case with a character for each character; one letter has a lower case of two."""
    low = text.lower()
    return low if len(low) == len(text) else text.replace("\u0130", "i").lower()


def luhn(digits: str) -> bool:
    d = [ord(c) - 48 for c in reversed(digits)]
    return (sum(d[::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def iban_valid(text: str) -> bool:
    t = text.replace(" ", "")
    t = t[4:] + t[:4]
    return 15 <= len(t) <= 34 and int("".join(str(int(c, 36)) for c in t)) % 97 == 1


def _addresses(run: str, at: int) -> Iterator[Span]:
    """A dotted run of numbers is read four parts at a time from its left end."""
    parts = run.split(".")
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
            yield "ip", at, end
        at = end + 1


def _anchored(text: str, automaton: ahocorasick.Automaton) -> Iterator[Span]:
    """Spans that start from anchors, each kind leftmost and without overlap."""
    ends = dict.fromkeys(("at", "plus", "scheme", "id", "secret", "ip", "card"), 0)
    last_at = 0
    for last, (kind, n) in automaton.iter(lowered(text)):
        start, after = last + 1 - n, last + 1
        if kind == "digit":
            # the first digit of a run expands to the right; the others lie inside
            if start >= ends["ip"] and (m := _DOTTED.match(text, start)):
                yield from _addresses(m[0], start)
                ends["ip"] = m.end()
            elif start >= ends["ip"]:
                ends["ip"] = _DIGITS.match(text, start).end()
            if start >= ends["card"] and (m := _CARD.match(text, start)):
                ends["card"] = m.end()
                if m.end() - start >= 13:
                    d = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(d) <= 19 and luhn(d):
                        yield "card", start, m.end()
        elif kind == "at":
            head = text[max(ends["at"], last_at) : start]
            last_at = after
            local = len(head) - len(head.rstrip(_LOCAL))
            if local and (m := _DOMAIN.match(text, after)):
                ends["at"] = m.end()
                yield "email", start - local, m.end()
        elif kind == "plus":
            if start >= ends["plus"] and (m := _PHONE.match(text, start)):
                ends["plus"] = m.end()
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    yield "phone", start, m.end()
        elif kind == "scheme":
            if start >= ends["scheme"] and _URL_HOST.match(text, after):
                end = after + len(_URL_REST.match(text, after)[0].rstrip(".,;:!?)]}"))
                ends["scheme"] = end
                yield "url", start, end
        elif kind == "id":
            if start >= ends["id"] and not (start and text[start - 1].isalnum()):
                at = _AFTER_ID.match(text, after).end()
                iban = _IBAN.match(text, at)
                m = iban if iban and iban_valid(iban[0]) else _ID.match(text, at)
                if m and at > after and sum(c.isdigit() for c in m[0]) >= 5:
                    ends["id"] = m.end()
                    yield "account", m.start(), m.end()
        elif kind == "secret":
            if start >= ends["secret"] and (m := _AFTER_SECRET.match(text, after)):
                ends["secret"] = m.end()
                yield "secret", *m.span(m.lastindex)
        elif start >= ends["secret"] and not (start and text[start - 1].isalnum()) and (m := _KEY[kind].match(text, start)):
            ends["secret"] = m.end()
            yield "secret", start, m.end()


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[Span]:
    """All spans of one text in code points, end exclusive, by kind as listed and then start."""
    return sorted(_anchored(text, automaton), key=lambda s: (KINDS.index(s[0]), s[1]))


def pii_spans(text: Column) -> Column:
    """``array<struct<kind, start, end>>`` for every text; empty for null or empty texts.

    Base kinds are the leftmost non-overlapping matches of the contract's
    patterns, validated. An Aho-Corasick automaton finds at-signs, plus signs,
    schemes and identifier cues; local parsers go left and right from them:
    email, phone, ``url`` (a scheme with a dotted host), ``account`` (an
    identifier with five digits or more, or a valid IBAN, after a cue) and
    ``secret`` (a value after a password or token cue, or an access key by its
    prefix). A digit is the anchor of addresses and cards: the first one of a
    run expands over the run. Texts of any length are read whole; each parser is
    linear in the text. Spans of one kind never overlap, the leftmost wins;
    repeated rows give the same spans.
    """
    text_batches(SparkSession.getActiveSession())

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton()
        of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(x.as_py() or "", automaton)] for x in batch]
            yield pa.array(rows, of)

    return find.asNondeterministic()(text)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``spans``; one of that name is replaced. Repeated rows are found again, empty tables stay empty."""
    return docs.withColumn("spans", pii_spans(docs[text]))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace each span that starts behind the last one's end by ``<KIND>``; overlapping spans go with the first."""
    spans = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    put = lambda a, s: F.when(s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
        F.struct(F.concat(a["out"], F.substring(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out"), s["end"].alias("at"))
    )
    done = F.aggregate(spans, zero, put, lambda a: F.concat(a["out"], F.substring(F.col(text), (a["at"] + 1).cast("int"), F.length(text))))
    return find_pii(docs, text).withColumn(text, done)


def digest_columns(spans: Column) -> dict[str, Column]:
    """The contract's counts and digests of a column of spans."""
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    of = lambda k: F.filter(spans, lambda s: s["kind"] == k)
    counts = {f"n_{k}": F.size(of(k)).cast("long") for k in BASE_KINDS}
    added = {f"n_{k}": F.size(of(k)).cast("long") for k in KINDS if k not in BASE_KINDS}
    return counts | {"base_sha256": F.sha2(listed(base), 256), "spans": listed(spans)} | added


def op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs).drop("text")
    return found.withColumns(digest_columns(F.col("spans")))
