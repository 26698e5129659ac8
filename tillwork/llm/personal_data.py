"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers expand and check them.

Anchors are at-signs, plus signs, digits, colons, schemes and identifier cues. Each parser looks only at the text around
its anchor and moves past what it has read, so a text is read a constant number of times, however long its runs are.
"""

from __future__ import annotations

import ipaddress
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import query, slices, table

#: Kinds in the order in which spans of one start are listed: the four base kinds, then those the method adds.
KINDS = ("email", "ip", "card", "phone", "mail", "login", "ip6", "account", "secret")
BASE = KINDS[:4]
SCHEMES = ("http", "https", "ftp", "sftp", "ssh", "git", "smb", "ldap", "postgres", "postgresql", "mysql", "mongodb", "redis", "amqp")
ACCOUNT_CUES = ("iban", "ssn", "social security", "account", "acct", "passport", "tax id", "konto", "cuenta", "compte")
SECRET_CUES = ("token", "secret", "api_key", "api-key", "apikey", "access_key", "access-key", "private_key", "client_key", "bearer")
PASSWORD_CUES = ("password", "passwd", "passphrase")
#: Fixed prefixes of issued keys with the least number of characters that follow.
KEY_PREFIXES = {"akia": 16, "ghp_": 30, "gho_": 30, "github_pat_": 30, "xoxb-": 20, "xoxp-": 20, "sk_live_": 16, "aiza": 30}
#: Lengths of international account numbers by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28,
    "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGITS = re.compile(r"[0-9]++")
QUAD = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WIDE_DOMAIN = re.compile(r"[^\W_]++(?:-++[^\W_]++)*+(?:\.[^\W_]++(?:-++[^\W_]++)*+)++")
LOGIN = re.compile(r"[^\s/?#@\"'<>:]+:[^\s/?#@\"'<>]+@(?:[A-Za-z0-9.-]+|\[[0-9A-Fa-f:.]+\])")
CUE_GAP = re.compile(r"[ \t]{0,3}(?:no\.?|number|nr\.?|num|#)?[ \t]{0,3}[:=#]?[ \t]{0,3}[\"']?", re.I)
ASSIGNED = re.compile(r"[A-Za-z0-9_-]{0,24}[\"']?[ \t]{0,3}(?::=|=>|=|:|[ \t])[ \t]{0,3}[\"']?")
SECRET = re.compile(r"[A-Za-z0-9_\-+/=.~]{16,512}+")
PASSWORD_GAP = re.compile(r"[\"']?[ \t]{0,3}(?::=|=>|=|:)[ \t]{0,3}[\"']?")
PASSWORD = re.compile(r"[^\s\"',;<>]{6,128}+")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ -]?[A-Za-z0-9]){11,30}")
SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
NUMBER = re.compile(r"[A-Z]{0,2}[0-9](?:[ -]?[0-9]){5,16}+(?![0-9A-Za-z])")
HEX = frozenset("0123456789abcdefABCDEF:")


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def iban_length(raw: str) -> int:
    """Characters of `raw` that hold a whole account number with a right check number; 0 if there is none."""
    want, kept = IBAN_LENGTHS.get(raw[:2].upper(), 0), []
    for at, c in enumerate(raw):
        if c.isalnum():
            kept.append(c.upper())
            if len(kept) == want:
                turned = "".join(kept[4:] + kept[:4])
                return at + 1 if int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 else 0
    return 0


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchors and cues in lower case with (parser, length)."""
    out = ahocorasick.Automaton()
    words = {c: "digit" for c in "0123456789"} | {"@": "at", "+": "plus", ":": "colon", "://": "scheme"}
    words |= dict.fromkeys(ACCOUNT_CUES, "account") | dict.fromkeys(SECRET_CUES, "secret")
    words |= dict.fromkeys(PASSWORD_CUES, "password") | dict.fromkeys(KEY_PREFIXES, "key")
    for word, parser in words.items():
        out.add_word(word, (parser, len(word)))
    out.make_automaton()
    return out


def _email(text: str, at: int, done: int) -> tuple[int, int] | None:
    after = DOMAIN.match(text, at + 1)
    if after is None:
        return None
    start = at
    while start > done and text[start - 1] in LOCAL:
        start -= 1
    return (start, after.end()) if start < at else None


def _wide_mail(text: str, at: int, done: int) -> tuple[int, int] | None:
    """Addresses with letters beyond ASCII in the name or in the domain, which the base pattern misses or cuts."""
    after = WIDE_DOMAIN.match(text, at + 1)
    if after is None:
        return None
    start = at
    while start > done and (text[start - 1] in LOCAL or text[start - 1] > "\x7f" and text[start - 1].isalnum()):
        start -= 1
    name = text[start:at].lstrip(".-")
    last = after.group().rpartition(".")[2]
    if not name or len(last) < 2 or not last.isalpha() or text[start : after.end()].isascii():
        return None
    return at - len(name), after.end()


def _ip6(text: str, at: int, done: int) -> tuple[int, int] | None:
    start, end, size = at, at + 1, len(text)
    while start > done and at - start < 40 and text[start - 1] in HEX:
        start -= 1
    while end < size and end - at < 40 and text[end] in HEX:
        end += 1
    while end > at + 1 and text[end - 1] == ":" and text[end - 2] != ":":
        end -= 1
    raw = text[start:end]
    if start and text[start - 1].isalnum() or end < size and text[end].isalnum():
        return None
    if sum(map(bool, raw.split(":"))) < 3 or not any(c.isdigit() for c in raw):
        return None
    try:
        ipaddress.IPv6Address(raw)
    except ValueError:
        return None
    return start, end


def _login(text: str, at: int) -> tuple[int, int] | None:
    """A user name and a password before the host of an address with a known scheme."""
    start = at
    while start and at - start < 12 and text[start - 1].isascii() and text[start - 1].isalnum():
        start -= 1
    found = LOGIN.match(text, at + 3, at + 1024) if text[start:at].lower() in SCHEMES else None
    return found and found.span()


def _account(text: str, end: int) -> tuple[int, int] | None:
    gap = CUE_GAP.match(text, end)
    at = gap.end() if gap else end
    if gap is None or at == end:
        return None
    if found := IBAN.match(text, at):
        if size := iban_length(found.group()):
            return at, at + size
    if found := SSN.match(text, at):
        area, group, serial = found.groups()
        return found.span() if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000" else None
    found = NUMBER.match(text, at)
    return found and found.span()


def _secret(text: str, end: int) -> tuple[int, int] | None:
    gap = ASSIGNED.match(text, end)
    found = SECRET.match(text, gap.end()) if gap else None
    if found is None:
        return None
    value = found.group().rstrip(".=")
    return (found.start(), found.start() + len(value)) if _random(value) else None


def _random(value: str, least: int = 3) -> bool:
    """Letters and digits mixed, so no word, name or number."""
    digits = sum(c.isdigit() for c in value)
    return len(value) >= 16 and digits >= least and len(value) - digits >= 3 and len(set(value.lower())) >= 6


def _password(text: str, end: int) -> tuple[int, int] | None:
    gap = PASSWORD_GAP.match(text, end)
    found = PASSWORD.match(text, gap.end()) if gap else None
    return found.span() if found and any(not c.isalpha() for c in found.group()) else None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then by kind.

    Within a kind spans do not overlap; each base kind holds exactly the leftmost matches of its pattern that pass its
    check, whatever the other kinds find.
    """
    low = text.encode().lower().decode()  # bytes: ASCII letters only, so places stay
    done = dict.fromkeys(KINDS, 0)
    found: list[tuple[str, int, int]] = []

    def keep(kind: str, span: tuple[int, int] | None) -> None:
        if span is not None and span[0] >= done[kind]:
            done[kind] = span[1]
            found.append((kind, *span))

    for last, (parser, size) in automaton().iter(low):
        at = last + 1 - size
        if parser == "digit":
            if at >= done["card"]:
                run = CARD.match(text, at)
                done["card"] = run.end() if run else at + 1
                if run and 14 <= len(digits := _digits(run.group())) <= 19 and luhn(digits):
                    found.append(("card", *run.span()))
            if at >= done["ip"]:
                quad = QUAD.match(text, at)
                done["ip"] = quad.end() if quad else DIGITS.match(text, at).end()
                if quad and all(map(_byte, quad.groups())):
                    found.append(("ip", *quad.span()))
        elif parser == "at":
            keep("email", _email(text, at, done["email"]))
            if not text.isascii():
                keep("mail", _wide_mail(text, at, done["mail"]))
        elif parser == "plus":
            call = PHONE.match(text, at)
            if call and 10 <= len(_digits(call.group())) <= 15:
                keep("phone", call.span())
        elif parser == "colon":
            if at >= done["ip6"] and at + 1 < len(text) and text[at + 1] in HEX:
                keep("ip6", _ip6(text, at, done["ip6"]))
        elif parser == "scheme":
            keep("login", _login(text, at))
        elif parser == "account":
            if at == 0 or not text[at - 1].isalnum():
                keep("account", _account(text, last + 1))
        elif parser == "secret":
            keep("secret", _secret(text, last + 1))
        elif parser == "password":
            keep("secret", _password(text, last + 1))
        elif parser == "key" and (at == 0 or not text[at - 1].isalnum()):
            value = SECRET.match(text, at)
            if value and value.end() - last - 1 >= KEY_PREFIXES[low[at : last + 1]] and _random(value.group(), 1):
                keep("secret", value.span())
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


SPAN = "struct<kind:string,start:bigint,`end`:bigint>"


def personal_data(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, spans): every row with its spans (kind, start, end), start and end in code points.

    Row by row, without a shuffle. Null and empty texts have no spans; repeated rows are searched each; the kept
    columns never leave Arrow, so any value of theirs comes back as it was. Other columns play no part.
    """
    kinds = dict(df.dtypes)
    columns = [f"_{i}" for i in range(len(keep))]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in slices(batches):
            found = [find_spans(t) for t in batch.column("_text").to_pylist()]
            offsets = [0]
            for spans in found:
                offsets.append(offsets[-1] + len(spans))
            flat = [x for spans in found for x in spans]
            parts = [pa.array([x[i] for x in flat], t.type) for i, t in enumerate(span)]
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(span)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), spans], [*columns, "spans"])

    rows = df.select(*(F.col(c).alias(n) for c, n in zip(keep, columns)), F.coalesce(text, F.lit("")).alias("_text"))
    head = ", ".join(f"{n} {kinds[c]}" for c, n in zip(keep, columns))
    return rows.mapInArrow(run, f"{head}, spans array<{SPAN}>").toDF(*keep, "spans")


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op12_personal_data")
def op12_personal_data(spark, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS long) AS n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed("spans").alias("spans"))
