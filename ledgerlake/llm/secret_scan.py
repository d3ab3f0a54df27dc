"""Secret scan with dictionary-primed zstandard novelty (operator 6).

Base kinds are plain patterns (``assign``, ``access``, ``hex``).  The method
adds ``novel`` spans: strings that stand in a sensitive context (after a word
such as "key" or "credential") and that zstandard can hardly shorten although
it has been primed with a dictionary of common identifiers and with the text
around them.  What a string costs is its marginal size: compressed bytes of
the surroundings with it, less those without it.  Every string within reach of
the identifier that holds the word is measured, that identifier's tail too.
Words and names, which are as new to the compressor as keys when they are
short, are told from random strings by how often their characters change kind
and, if they are letters of one case, by their vowels.

Whole texts are scanned, in one pass without a shuffle.  Null texts count as
empty and give no spans; repeated rows and null ids keep one result each; an
empty table gives no rows; offsets are code points, ends exclusive; spans that
start together go in the order of the kinds.  Other columns can have any name.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .common import pick

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of that class is matched whole, so this equals "32 or more of a run"
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: A sensitive word and, on the same line and near it, a string of the alphabet of keys.
SENSITIVE = re.compile(r"(?:password|passwd|passphrase|pwd|secret|token|api[ _-]?key|private[ _-]?key|access[ _-]?key|"
                       r"credentials?|authorization|bearer|auth)", re.IGNORECASE | re.ASCII)
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")
#: An assignment's = ends a name; at the end of a string it is padding.
LEAST, LONG = 8, 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.~!@#$%%^&*?-]{%d,}={0,2}" % LEAST)
SYMBOLS = re.compile(r"[.~!@#$%^&*?]")
IDENTIFIER_TAIL = re.compile(r"[A-Za-z0-9_-]*")
#: Runs of one kind; a capital belongs to the small letters after it.
RUNS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Identifiers and phrases that code around secrets is made of: the dictionary that primes the compressor.
IDENTIFIERS = (
    "access_key access_token account_id api_key apiKey application/json Authorization: Bearer auth_token "
    "AWS_ACCESS_KEY_ID AWS_SECRET_ACCESS_KEY aws_session_token base64 client_id client_secret clientSecret "
    "config.get connection_string const content-type credentials database_url decode default encode encryption_key "
    "environ environment export false function getenv github_token hash headers host http:// https://www. import "
    "localhost login master_key module.exports null os.environ.get password= passwd private_key process.env.PASSWORD "
    "public_key refresh_token require return secret_key secretKey self. session_token settings signature string "
    "true token= undefined user_name username utf-8 value var version webhook_url xoxb- x-api-key "
    "-----BEGIN RSA PRIVATE KEY----- ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 "
    "00000000000000000000 xxxxxxxxxxxxxxxxxxxxxxxx ________________ ----------------").encode()


@dataclass(frozen=True)
class NoveltyRules:
    """reach: characters between the end of the sensitive word's identifier and the string; around: of text
    on each side that primes the compressor; ratio: marginal bytes per character from which a string is reported."""

    reach: int = 24
    around: int = 512
    ratio: float = 0.85
    level: int = 12


class Novelty:
    """Marginal compressed size of a string within its surroundings."""

    def __init__(self, rules: NoveltyRules):
        import zstandard

        self.rules, self.z = rules, zstandard
        self.params = zstandard.ZstdCompressionParameters.from_level(
            rules.level, write_content_size=0, write_checksum=0, write_dict_id=0)

    def marginal(self, candidate: str, before: str, after: str) -> int:
        around = IDENTIFIERS + after.encode("utf-8", "replace") + before.encode("utf-8", "replace")
        primed = self.z.ZstdCompressionDict(around, dict_type=self.z.DICT_TYPE_RAWCONTENT)
        compress = self.z.ZstdCompressor(dict_data=primed, compression_params=self.params).compress
        tail = before[-32:].encode("utf-8", "replace")
        return len(compress(tail + candidate.encode())) - len(compress(tail))

    def spans(self, text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        low = text.lower()
        if not any(w in low for w in SENSITIVE_WORDS):
            return []
        r, found, at, name_end = self.rules, [], 0, 0
        for word in SENSITIVE.finditer(text):
            if word.end() > name_end:
                name_end = IDENTIFIER_TAIL.match(text, word.end()).end()
            limit = name_end + r.reach
            line_end = text.find("\n", word.end(), limit + LEAST)
            stop = limit + LEAST if line_end < 0 else line_end  # what starts within reach has its LEAST characters there
            at = max(at, word.end())
            while m := CANDIDATE.search(text, at, stop):
                s, at = m.start(), CANDIDATE.match(text, m.start()).end()
                e = at
                if text[e:e + 1] not in ('"', "'", "`"):  # a sentence's end, outside quotes
                    e = s + len(text[s:e].rstrip(".?!"))
                covered = max((min(e, y) - max(s, x) for _, x, y in taken if s < y and x < e), default=0)
                if e - s - covered < LEAST or not _random_looking(text[s:e]):
                    continue
                if self.marginal(text[s:e], text[max(0, s - r.around):s], text[e:e + r.around]) >= r.ratio * (e - s):
                    found.append(("novel", s, e))
        return found


def _random_looking(s: str) -> bool:
    """Whether characters are mixed as in no name or word; short strings must be mixed more than long ones."""
    runs, digits = RUNS.findall(s), sum(c.isdigit() for c in s)
    size = sum(map(len, runs))
    long = len(s) >= LONG
    if digits == size:
        return long and digits == len(s)
    if digits >= 2:
        return long and not SYMBOLS.search(s) or size <= 3 * len(runs)
    if size <= (3.4 if long else 2) * len(runs):
        return True
    one_case = s.isalpha() and (s.islower() or s.isupper())
    return long and one_case and sum(c in "aeiouy" for c in s.lower()) < 0.25 * len(s)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the base kinds, in order of start, then kind."""
    low, found = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return _ordered(found)


def _ordered(spans):
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def told(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan_batches(rules: NoveltyRules):
    def run(batches):
        import pyarrow as pa

        novelty = Novelty(rules)
        for batch in batches:
            texts = batch.column("text")
            out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                base = base_spans(text)
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(told(base).encode()).hexdigest())
                out["spans"].append(told(_ordered(base + novelty.spans(text, base))))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(out.values(), kinds))],
                names=["doc_id", *out])
    return run


def scan(docs: DataFrame, rules: NoveltyRules = NoveltyRules(), id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    src = pick(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(_scan_batches(rules), f"doc_id {dict(src.dtypes)['doc_id']}, n_assign long, n_access long, "
                                                "n_hex long, base_sha256 string, spans string")
