"""Secret scans: an Aho-Corasick keyword prefilter, anchored regular expressions only at
its hits, then validation of embedded checksums.

One automaton run over a text finds every keyword of every kind. At a hit the kind's
expression is tried at that position only; matches of a kind do not overlap. Hex runs have
no keyword and are found by one direct scan. Kinds of the second list are kept only if what
they carry checks out: the CRC-32 in GitHub and npm tokens, the JSON header of a JWT.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import aliased, map_texts

# The base kinds in their listed order.
ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("github", "npm", "jwt", "private_key")
KINDS = BASE_KINDS + ADDED_KINDS

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return out


def token_checksum_ok(m: re.Match) -> bool:
    """The last six of a token's characters are the base-62 CRC-32 of those before."""
    body = m.group(1)
    return body[-6:] == base62(zlib.crc32(body[:-6].encode())).rjust(6, "0")


def jwt_header_ok(m: re.Match) -> bool:
    part = m.group(0).split(".")[0]
    try:
        head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(head, dict) and "alg" in head


class Rule:
    """A kind with its keywords (lowercase), its expression and which matches to keep. ``run``: where
    the expression fails, it fails from every later place of this run of characters as well, so
    hits within it are passed over and the work stays in proportion to the text. A keyword in other
    letter case begins no run: the expression may still match further on."""

    def __init__(self, kind, keywords, pattern, keep, flags=0, run=None):
        self.kind, self.keywords, self.keep = kind, keywords, keep
        self.match = re.compile(pattern, re.ASCII | flags).match
        self.run = re.compile(run).match if run else None


def rules() -> list[Rule]:
    return [
        Rule("assign", ASSIGN_KEYWORDS, ASSIGN,
             lambda m: len(m.group(1)) >= MIN_ASSIGNED, re.IGNORECASE),
        Rule("access", ("akia",), r"AKIA[A-Z0-9]+", lambda m: len(m.group(0)) >= MIN_ACCESS),
        Rule("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
             r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", token_checksum_ok),
        Rule("npm", ("npm_",), r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", token_checksum_ok),
        Rule("jwt", ("eyj",), r"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", jwt_header_ok,
             run=r"eyJ[A-Za-z0-9_-]+"),
        Rule("private_key", ("-----begin ",),
             r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+"
             r"-----END (?:[A-Z]+ )?PRIVATE KEY-----", lambda m: True),
    ]


_UPPER = {c: c + 32 for c in range(65, 91)}
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)


class Scanner:
    """Spans ``(kind, start, end)`` in code points of a text, end exclusive, by start
    and then in the order of ``KINDS``."""

    def __init__(self):
        import ahocorasick

        self.rules = rules()
        self.automaton = ahocorasick.Automaton()
        for i, rule in enumerate(self.rules):
            for word in rule.keywords:
                self.automaton.add_word(word, (i, len(word)))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        low = text.lower()
        if len(low) != len(text):  # a few letters grow in lower case; offsets must hold
            low = text.translate(_UPPER)
        hits: dict[int, list[int]] = {}
        for end, (i, n) in self.automaton.iter(low):
            hits.setdefault(i, []).append(end - n + 1)
        found = [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
        for i, starts in hits.items():
            rule, free = self.rules[i], 0
            for at in sorted(starts):
                if at < free:
                    continue
                m = rule.match(text, at)
                if m is not None:
                    free = m.end()
                    if rule.keep(m):
                        found.append((rule.kind, m.start(), m.end()))
                elif rule.run is not None and (r := rule.run(text, at)) is not None:
                    free = r.end()
        found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
        return found


SPANS = "spans array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``spans`` of every row.

    A null text counts as empty; empty texts and tables have no spans; repeated rows
    are scanned each; other columns are ignored. No shuffle."""
    def make():
        find = Scanner()

        def work(texts):
            return [[[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts]]
        return work

    return map_texts(docs, make, SPANS, keep=keep)


def _digest(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(docs: DataFrame) -> DataFrame:
    """One row a document: counts of the base kinds, a hash of their spans, all spans."""
    def make():
        find = Scanner()

        def work(texts):
            out = []
            for t in texts:
                spans = find(t)
                base = [s for s in spans if s[0] in BASE_KINDS]
                out.append([sum(s[0] == k for s in base) for k in BASE_KINDS]
                           + [hashlib.sha256(_digest(base).encode()).hexdigest(), _digest(spans)])
            return [list(c) for c in zip(*out)] if out else [[]] * 5
        return work

    return map_texts(docs, make, "n_assign bigint, n_access bigint, n_hex bigint, "
                                 "base_sha256 string, spans string")


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Overlapping spans joined, under the kind that starts first."""
    out: list[tuple[str, int, int]] = []
    for kind, a, b in spans:
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(b, out[-1][2]))
        else:
            out.append((kind, a, b))
    return out


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by ``[kind]`` and ``n_chars`` (where there is
    such a column) counted again for changed texts. Null texts stay null."""
    def make():
        find = Scanner()

        def clean(text):
            if not (spans := merged(find(text))):
                return None
            out, at = [], 0
            for kind, a, b in spans:
                out += [text[at:a], f"[{kind}]"]
                at = b
            return "".join([*out, text[at:]])
        return lambda texts: [[clean(t) for t in texts]]

    rows, at, back = aliased(docs)
    done = map_texts(rows, make, "clean string", keep=tuple(rows.columns), text=at["text"])
    new = {"text": F.coalesce("clean", at["text"])}
    if "n_chars" in at:
        new["n_chars"] = F.when(F.col("clean").isNotNull(), F.char_length("clean")).otherwise(
            F.col(at["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return back(done, **new)
