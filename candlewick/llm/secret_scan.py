"""Secret scan: pattern spans plus dictionary-primed zstandard novelty.

Pattern kinds ``assign``, ``access`` and ``hex`` are reported as they match.  The
novelty kind ``novel`` looks at runs of key-like characters near a sensitive word
that no pattern span covers: the run's marginal compressed bits, given a
dictionary of usual identifiers and the text around it, are set against what its own
alphabet can hold (hexadecimal digits, or the kinds of characters that it has).  Prose, identifiers and repeats
cost little; a run that costs about all its alphabet can hold is incompressible and is reported.
A run of letters of one case, but for a capital at its start, needs a stretch of ``letters`` of them, longer than words are.

Defined results: null text is empty text and has no span; offsets are code points
with exclusive ends; every text is read whole, whatever its length, in time linear in it; repeated rows
give repeated results; other columns are not read, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import give_back_memory, table

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key", "credential", "private", "bearer",
             "authorization", "passphrase", "pwd")
IDENTIFIERS = (
    "access_token refresh_token api_key apikey client_secret client_id password passwd username user_name secret_key "
    "private_key public_key authorization bearer credential credentials session_id config settings environment "
    "getElementById addEventListener querySelector prototype constructor toString valueOf hasOwnProperty undefined "
    "function return import export default class static public private protected void string integer boolean "
    "application/json content-type text/html utf-8 https:// http://www. localhost 127.0.0.1 /usr/local/bin /var/lib "
    "example changeme placeholder your_token_here xxxxxxxxxxxx 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ the and that with from this which have licensed under version copyright").encode()
SPANS = ("n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string, "
         "found array<struct<kind:string,start:int,end:int>>")


def base_spans(text: str, low: str, assign: re.Pattern, access: re.Pattern, hexes: re.Pattern) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the pattern spans; ``low`` is the lower-cased text, for a quick look only."""
    found = []
    if any(k in low for k in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
    return sorted(found)


def capacity(run: str) -> float:
    """Bits a character of the run's alphabet: hexadecimal digits of one case, or the kinds of characters that it has."""
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", run):
        return 4.0
    kinds = ((26, "[a-z]"), (26, "[A-Z]"), (10, "[0-9]"), (6, "[+/_=.-]"))
    return max(1.0, math.log2(sum(n for n, kind in kinds if re.search(kind, run))))


def scan_udf(reach: int = 64, around: int = 256, least: int = 16, novelty: float = 0.93, letters: int = 28, level: int = 3):
    """A pandas UDF over texts.  reach: code points between a sensitive word and a candidate's nearer end; around: text on
    either side that primes the dictionary; least: shortest candidate; novelty: marginal bits to what the alphabet
    holds; letters: stretch that a run without digits and of one case must have."""

    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        assign, access = re.compile(ASSIGN, re.ASCII | re.IGNORECASE), re.compile("AKIA[A-Z0-9]+")
        hexes = re.compile("[0-9a-f]{16,}")  # a run's whole length decides, so shorter runs need not be matched
        words, runs = re.compile("|".join(SENSITIVE), re.IGNORECASE), re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % least)
        stretch = re.compile("[a-z]{%d}|[A-Z]{%d}|[0-9]{%d}" % (letters, letters, letters))
        primer = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primer.precompute_compress(level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=primer, write_content_size=False, write_checksum=False)

        def size(data: str) -> int:
            return len(packer.compress(data.encode("utf-8", "replace")))

        def novel(text: str, base: list[tuple[int, int, int]]) -> set[tuple[int, int, int]]:
            extra: set[tuple[int, int, int]] = set()
            near = [w.span() for w in words.finditer(text)]
            if not near:
                return extra
            ends = [e for _, e in near]
            taken, reached = [], -1  # where pattern spans start, and the furthest end up to each
            furthest = []
            for a, _, b in base:
                reached = max(reached, b)
                taken.append(a)
                furthest.append(reached)
            for m in runs.finditer(text):  # whole runs; the nearer end decides about reach
                a, b = m.span()
                k = bisect.bisect_left(ends, a - reach)
                if k == len(near) or near[k][0] > b + reach:
                    continue
                run = m[0]
                k = bisect.bisect_left(taken, b)  # pattern spans that start before the run ends
                if k and furthest[k - 1] > a:
                    continue
                kinds = sum(bool(re.search(kind, run[1:])) for kind in ("[a-z]", "[A-Z]", "[0-9]"))  # words may begin with a capital
                if kinds < 2 and not stretch.search(run):
                    continue
                before, after = text[max(0, a - around):a], text[b:b + around]
                if 8 * (size(before + after + run) - size(before + after)) >= novelty * capacity(run) * len(run):
                    extra.add((a, 3, b))
            return extra

        for texts in batches:
            out = []
            for text in texts:
                text = text or ""
                low = text.lower()
                base = base_spans(text, low, assign, access, hexes)
                extra = novel(text, base)
                named = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base]
                spans = sorted([*base, *extra])
                count = [sum(k == i for _, k, _ in spans) for i in range(4)]
                out.append((*count, hashlib.sha256(",".join(named).encode()).hexdigest(),
                            ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans),
                            [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]))
            yield pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans", "found"])
            give_back_memory()

    return scan


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per row: the id, counts by kind, the digest of the pattern spans, all spans as text and as structs."""
    out = docs.select(F.col(id_col), scan_udf(**limits)(F.col(text_col)).alias("_s"))
    return out.select(id_col, "_s.*")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("found")
