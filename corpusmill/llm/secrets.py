"""Problem 1: credentials embedded in source code and chat turns.

A text is scanned line-wise around credential words, key containers are parsed by their grammar (armour with
its fields, DER values of PKCS#1, #8, #12 and SEC 1, OpenSSH envelopes, OpenPGP packets), and base64, hex, percent and backslash layers are decoded and rescanned. Every
finding carries the spans to redact, so that an encoded literal is replaced as a whole and code around it stays as it was.

Defined results: null, empty or blank text has no findings and is returned unchanged; repeated rows each report their own
findings; a message without content has none. Whole texts are scanned, whatever their length.
"""

from __future__ import annotations

import base64
import binascii
import re
from bisect import bisect_left
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import map_columns

#: Encoded layers that are opened; None: until nothing decodes. Each layer is shorter than the one around it.
MAX_LAYERS: int | None = None


class Finding(NamedTuple):
    start: int
    kind: str
    spans: tuple[tuple[int, int], ...]


# Openings and rests of public providers' tokens.
PROVIDERS = (
    (("sk-",), r"[A-Za-z0-9_-]{20,}"),
    (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"[A-Za-z0-9]{30,}"),
    (("github_pat_",), r"\w{22,}"),
    (("glpat-",), r"[\w-]{18,}"),
    (("AKIA", "ASIA"), r"[A-Z0-9]{16}"),
    (("AIza",), r"[\w-]{30,}"),
    (("xoxa-", "xoxb-", "xoxe-", "xoxp-", "xoxr-", "xoxs-"), r"[A-Za-z0-9-]{16,}"),
    (tuple(f"{k}_{mode}_" for k in ("tok", "sk", "pk", "rk") for mode in ("live", "test")), r"[A-Za-z0-9]{16,}"),
    (("npm_", "hf_"), r"[A-Za-z0-9]{30,}"),
    (("SG.",), r"[\w-]{16,}\.[\w-]{16,}"),
    (("ya29.",), r"[\w-]{20,}"),
    (("eyJ",), r"[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{16,}"),
)
PROVIDER = re.compile("(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{'|'.join(map(re.escape, heads))}){rest}" for heads, rest in PROVIDERS) + ")(?![A-Za-z0-9])")
# Names that hold a credential. Those of ``KEY_OWNERS`` end in key.
KEY_OWNERS = ("api", "access", "private", "encryption", "signing", "account")
CRED = (
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret(?:[_-]?(?:access[_-]?)?key)?"
    rf"|(?:{'|'.join(KEY_OWNERS)})[_-]?key|auth(?:[_-]?token|[_-]?key)?|token|credentials?)"
)
# Parameters of a URL's query besides.
QUERY_NAMES = ("token", "api_?key", "key", "sig", "signature", "password", "passwd", "pwd", "auth", "secret")
# Methods that take a user and a password.
LOGINS = ("login", "log_in", "connect", "set_auth", "auth", "authenticate", "set_credentials", "basic_auth", "signin", "sign_in")
# Words that introduce a credential in prose of the corpus languages; those of ``PROSE_EAST`` need no word boundary.
PROSE_WORDS = ("key", "token", "password", "passwd", "passphrase", "secret", "pass", "pw", "contraseña", "clave", "mot de passe", "jeton", "passwort", "kennwort", "schlüssel")
PROSE_EAST = ("비밀번호", "토큰", "키", "パスワード", "トークン", "キー", "密码", "令牌", "密钥")
# What each match of a pattern below must hold on the line where it begins: in any case (lower case here), and as it stands.
HINTS = tuple(
    dict.fromkeys(
        (
            "pass", "pwd", "secret", "auth", "token", "credential", *(owner + sep + "key" for owner in KEY_OWNERS for sep in ("", "_", "-")),
            *(name.replace("_?", "") + "=" for name in QUERY_NAMES), "api_key=", *PROSE_WORDS, *PROSE_EAST,
            *(f".{name}" for name in LOGINS), "bearer", '"basic', "'basic", "://",
        )
    )
)
EXACT = (*(head for heads, _ in PROVIDERS for head in heads), "-u", "--user", "--proxy-user", "sshpass", "mysql")
#: Hints that hold another hint are found with it.
HINTS = tuple(h for h in HINTS if not any(o != h and o in h for o in HINTS))
EXACT = tuple(h for h in EXACT if not any(o in h.lower() for o in HINTS) and not any(o != h and o in h for o in EXACT))
#: Letters that a pattern takes for another one where case doesn't matter.
ALIKE = {"ſ": "s", "ı": "i", "İ": "i", "\u212a": "k"}
QUOTED = r"[bBrRuUfF]{0,2}(?P<q>\"\"\"|'''|\\?[\"'])(?P<v>(?:(?!(?P=q))[^\n])+?)(?P=q)"
PIECES = re.compile(r"\s*(?:\+\s*|\\\n\s*)?[bBrRuUfF]{0,2}([\"'])((?:(?!\1)[^\\\n])*)\1")
ASSIGN = re.compile(
    rf"(?i:{CRED})(?![A-Za-z0-9_])\\?[\"']?\]?\s*(?:=>|:=|(?::\s*(?:str|bytes|String|Optional\[str\]|str \| None)\s*)?=(?!=)|:(?!:))\s*"
    rf"(?:\(\s*)?(?:{QUOTED}|(?P<u>[^\s\"'<>,;)\]}}&#`](?:[^\s\"'<>,;)\]}}&`])*))"
)
MARKUP = re.compile(rf"(?i:{CRED})\s*>\s*(?P<v>[^<\s][^<]*?)\s*</|(?i:{CRED})[\"']\s+(?:content|value)\s*=\s*[\"'](?P<w>[^\"'\n]+)[\"']")
DEFAULT = re.compile(
    rf"[\"']-{{1,2}}[\w-]*?(?i:{CRED})[\"'][^\n]*?default\s*=\s*[bruf]?[\"'](?P<v>[^\"'\n]+)[\"']"
    rf"|(?:environ\.get|getenv|\.get|setdefault|pop)\(\s*[\"'][\w.-]*?(?i:{CRED})[\"']\s*,\s*[bruf]?[\"'](?P<w>[^\"'\n]+)[\"']"
)
URL = re.compile(r"(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9+.-]*://(?P<u>[^\s:/@\"'<>`]*):(?P<v>[^\s@\"'<>`]+)@(?=[\w.\[{-])")
QUERY = re.compile(rf"(?i)[?&](?:[a-z]+[_-])?(?:{'|'.join(QUERY_NAMES)})=(?P<v>[^&\s\"'<>#`]+)")
HEADER = re.compile(
    r"(?i)authorization\\?[\"']?\s*[:=,]\s*[bf]?\\?[\"']?(?P<s>bearer|basic|token|apikey)\s+(?P<v>[^\s\"'<>`\\]+)|[\"'](?P<t>bearer|basic)\s+(?P<w>[^\s\"'<>`\\]+)[\"']"
    r"|(?<![a-z0-9])x-[a-z0-9-]*?(?:key|token|secret|auth)\\?[\"']?\s*[:=]\s*\\?[\"']?(?P<x>[^\s\"'<>`\\]+)"
)
CALL = re.compile(
    rf"(?i)(?:\.(?:{'|'.join(LOGINS)})|httpbasicauth|auth\s*=\s*)\(\s*[bruf]?[\"'][^\"'\n]*[\"']\s*,\s*"
    r"(?:\w+\s*=\s*)?[bruf]?[\"'](?P<v>[^\"'\n]+)[\"']"
)
COMMAND = re.compile(
    r"(?:(?<=\s)|(?<=[\"']))(?:-u|--user|--proxy-user)[\"']?(?:\s*,\s*|[\s=]+)[\"']?(?P<u>[^\s:\"',]+):(?P<v>[^\s\"']+)"
    r"|sshpass\s+-p\s*[\"']?(?P<w>[^\s\"']+)|\bmysql\w*\b[^\n]*?\s-p(?P<x>[^\s\"']+)"
)
PROSE = re.compile(
    rf"(?i)(?:\b(?:{'|'.join(PROSE_WORDS)})|{'|'.join(PROSE_EAST)})"
    r"\s*(?:is|was|ist|lautet|est|es|:|=|는|은|가|이|は|是|为|：)\s*:?\s*[\"'`]?(?P<v>[^\s\"'`,;<>]+)"
)
# Stand-ins that are no credentials.
STAND_IN = re.compile(
    r"(?i)(?:<.*>?|&lt;.*|\$\{.*|\$\(.*|\$\w+|\{.*\}?|%\(.*|%\w+%|\[.*\]|[*.\-_#x•]+|your.*|my[-_ ]?(?:secret|password|token|key|pass).*|change.?(?:me|this|it).*|replace.?(?:me|this).*|to.?do.*|fix.?me.*"
    r"|none|null|nil|true|false|undefined|default|example|sample|test(?:ing)?|dummy|fake|placeholder|redacted.*|masked|hidden|removed|secret|password|passwd|passw0rd|pass|pwd|token|key|apikey|api_key|required|optional"
    r"|string|str|bytes|int|n/?a|insert.*|enter.*|vault[:/].*|ssm[:/].*|secretsmanager.*|secret[:/].*|arn:.*|env[:.].*|file:.*|keyring:.*|op://.*|gcp?:.*|/.*|\.{1,2}/.*|~/.*|getpass.*|os\.(?:environ|getenv).*"
    r"|(?:md5|sha\d*|sha-\d+|etag|commit)[:=-].*|user|username|admin|foo|bar|baz|empty|blank|unset|disabled|enabled)"
)
MASKED = re.compile(r"\*{3,}|x{5,}|X{5,}|\.{3,}|…|•{3,}|EXAMPLE|<[a-z]")
SNAKE = re.compile(r"_*[a-z]+(?:_[a-z0-9]+)*_*|_*[A-Z]+(?:_[A-Z0-9]+)*_*|[a-z]+(?:\.[a-z_]+)*|[A-Za-z]+")
WORDS_NUMBER = re.compile(r"[a-z]{3,}(?:-[a-z]{2,}){2,}-\d{1,6}")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*?)PRIVATE KEY(?: BLOCK)?-----(.*?)(?:-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----|\Z)", re.S)
RUN = re.compile(r"(?<![A-Za-z0-9+/_%=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_-])")
# A line of a wrapped run that is followed by another, and what stands between two lines.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_%-])[A-Za-z0-9+/_-]{16,}(?=[ \t]*\\?\r?\n[ \t]*(?:(?:[#*;>]+|//|--)[ \t]+)?[A-Za-z0-9+/_-]|(?:\\r)?\\n[A-Za-z0-9+/_-])")
WRAP = re.compile(r"[ \t]*\\?\r?\n[ \t]*(?:(?:[#*;>]+|//|--)[ \t]+)?|(?:\\r)?\\n")
WRAPPED_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# Calls that decode their argument.
DECODERS = ("b64decode", "decodebytes", "decodestring", "a2b_base64", "from_base64", "fromhex", "unhexlify", "a2b_hex", "codecs.decode", "atob")
DECODER = re.compile(rf"(?:{'|'.join(map(re.escape, DECODERS))})\(\s*[bBrRuU]{{0,2}}([\"'])(?P<v>(?:(?!\1)[^\n\\])+)\1")
SUFFIX = re.compile(r"(?i)[_-]?(?:b64|base64|hex|enc|encoded)(?=\\?[\"']?\]?\s*[:=])")
#: A percent sign that was encoded over and over.
PERCENTS = re.compile(r"%(?:25)+(?=[0-9A-Fa-f]{2})")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2}[\w.~+/:;@-]*)+")
BACKSLASH = re.compile(r"(?:\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}){2,}")


def _mixed(v: str) -> bool:
    return bool(re.search(r"[a-z]", v)) + bool(re.search(r"[A-Z]", v)) + bool(re.search(r"\d", v)) + bool(re.search(r"[^\w\s]", v)) >= 3


def strong(v: str) -> bool:
    """Whether a value looks like a credential by its own form, without a name beside it."""
    if len(v) < 8 or MASKED.search(v) or STAND_IN.fullmatch(v):
        return False
    if len(set(v)) < 6:
        return False
    if PROVIDER.fullmatch(v) or WORDS_NUMBER.fullmatch(v) or re.fullmatch(r"[0-9a-f]{24,}|[0-9A-F]{24,}", v):
        return True
    if "://" in v or re.search(r"[()\[\]{}\\|]", v) or SNAKE.fullmatch(v):
        return False
    if re.fullmatch(r"[A-Za-z0-9+/_-]{20,}={0,2}", v):
        return _mixed(v) and not re.fullmatch(r"(?:[A-Za-z]*[a-z_]+[/_-])+[\w-]*", v)
    return _mixed(v) and len(re.findall(r"[A-Za-z]", v)) >= 4 and bool(re.search(r"\d", v)) and not re.fullmatch(r"[a-z0-9_.-]+\.[a-z]{2,4}|[\w.-]+\.(?:com|org|net|example|test|invalid)(?:[/:].*)?|v?\d+(?:\.\d+)+\S*", v)


def literal(v: str, quoted: bool) -> bool:
    """Whether a value stored under a credential's name is a working literal."""
    v = v.strip()
    if len(v) < 6 or "://" in v or re.search(r"\s", v) or STAND_IN.fullmatch(v) or MASKED.search(v):
        return False
    if strong(v):
        return True
    if not quoted or SNAKE.fullmatch(v):
        transitions = len(re.findall(r"[a-z][A-Z]|[A-Z][a-z]", v))
        return quoted and len(v) >= 16 and v.isalpha() and transitions >= 5
    if re.search(r"[()\[\]{}]", v) and not re.search(r"\d", v):
        return False
    kinds = bool(re.search(r"[A-Za-z]", v)) + bool(re.search(r"\d", v)) + bool(re.search(r"[^\w\s]", v))
    if re.fullmatch(r"[a-z]+(?:-[a-z]+)*", v):
        return v.count("-") >= 3
    return kinds >= 2 and not re.fullmatch(r"[\d.,:/-]+|[a-z_]+\d*|[\w.-]+\.(?:example|test|invalid|py|json|txt)\S*", v)


# Openings of the object identifiers of key algorithms, encryption schemes and container contents.
OIDS = (bytes.fromhex("2a8648"), bytes.fromhex("2b65"), bytes.fromhex("2b81"), bytes.fromhex("2b0e"), bytes.fromhex("6086"))


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill ``data[at:end]`` in DER, or None where they don't."""
    out = []
    while at < end:
        one = _head(data, at, end)[:1]
        if not one:
            return None
        out += one
        at = one[0][2]
    return out


def _head(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    """The first two values of ``data[at:end]``, or one or none where it breaks off before."""
    out: list[tuple[int, int, int]] = []
    while len(out) < 2 and at + 2 <= end:
        tag, n, at = data[at], data[at + 1], at + 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                break
            n, at = int.from_bytes(data[at : at + k]), at + k
        if at + n > end:
            break
        out.append((tag, at, at + n))
        at += n
    return out


def _algorithm(data: bytes, element: tuple[int, int, int]) -> bool:
    """Whether a value is an algorithm identifier: a sequence that opens with a known object identifier."""
    inner = _elements(data, *element[1:]) if element[0] == 0x30 else None
    return bool(inner) and inner[0][0] == 0x06 and data[inner[0][1] : inner[0][2]].startswith(OIDS)


def _openssh(data: bytes) -> bool:
    """The envelope of an OpenSSH key: cipher, key derivation and its options, the number of keys, public keys and the private part."""
    at = 15

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4])
        value = data[at + 4 : at + 4 + n]
        at += 4 + n
        return value if len(value) == n and at <= len(data) else None

    cipher, derivation, options = field(), field(), field()
    if not cipher or not derivation or options is None or not cipher.isascii() or not derivation.isascii():
        return False
    keys, at = int.from_bytes(data[at : at + 4]), at + 4
    return 1 <= keys <= 64 and all(field() for _ in range(keys)) and bool(field())


def container(data: bytes) -> str | None:
    """The private key container that bytes are by their binary grammar, or None.

    PKCS#1 (version and at least eight numbers), DSA, SEC 1 (version, key), PKCS#8 (version, algorithm, key), encrypted PKCS#8 (algorithm,
    data), PKCS#12 (version 3 and contents), an OpenSSH envelope, an OpenPGP secret key packet. What opens like one of them but doesn't hold
    together to the end is ``damaged``: it may be cut off or altered, and still gives the key away.
    """
    if data.startswith(b"openssh-key-v1\0"):
        return "openssh" if _openssh(data) else "damaged"
    if data[:1] in (b"\x94", b"\x95", b"\x96", b"\xc5"):  # secret key packet: length, then version 4 or 6
        width = {0x94: 1, 0x95: 2, 0x96: 4}.get(data[0], 1 if data[1:2] < b"\xc0" else 2)
        return "openpgp" if data[1 + width : 2 + width] in (b"\x04", b"\x06") and len(data) > 40 else None
    outer = _elements(data, 0, len(data)) or _elements(data, 0, len(data.rstrip(b"\0\r\n"))) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return None
    head = _head(data, *outer[0][1:])
    version, second = (data[head[0][1] : head[0][2]], head[1]) if len(head) > 1 and head[0][0] == 0x02 else (b"", None)
    inner = _elements(data, *outer[0][1:])
    tags = bytes(t for t, _, _ in inner) if inner else b""
    if inner and _algorithm(data, inner[0]):
        return "pkcs8 encrypted" if tags == b"\x30\x04" else None
    if version == b"\x03" and second[0] == 0x30:
        first = _head(data, *second[1:])
        return "pkcs12" if first and first[0][0] == 0x06 else None
    if version not in (b"\0", b"\1") or second[2] - second[1] < 5:
        return None
    if second[0] == 0x30:
        return "pkcs8" if tags[2:3] == b"\x04" and _algorithm(data, second) else "damaged"
    if second[0] == 0x04:
        return "sec1" if inner and second[2] - second[1] >= 16 else "damaged"
    if second[0] == 0x02:
        return ("pkcs1" if len(tags) >= 9 else "dsa") if len(tags) >= 6 and set(tags) == {0x02} else "damaged"
    return None


def armoured(body: str) -> str | None:
    """What a private key block holds: the container that its lines encode, ``opaque`` for other key material, None for none.

    Header fields (encryption, comments, checksum) are read over. Key material that no grammar knows, as of formats to come, still counts:
    the armour says what it is.
    """
    if MASKED.search(body):
        return None
    lines = [x.strip() for x in body.replace("\\r", "").replace("\\n", "\n").split("\n")]
    run = "".join(re.sub(r"[^A-Za-z0-9+/]", "", x) for x in lines if ":" not in x and not x.startswith("=")).replace("REDACTED", "")
    if len(run) < 40:
        return None
    data = _decoded(run)
    return data and container(data) or "opaque"


def _text(data: bytes) -> str | None:
    try:
        s = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return s if s and sum(c.isprintable() or c in "\r\n\t" for c in s) >= 0.97 * len(s) else None


def _decoded(run: str) -> bytes | None:
    if re.fullmatch(r"(?:[0-9a-f]{2}){8,}|(?:[0-9A-F]{2}){8,}", run):
        return bytes.fromhex(run)
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def _basic(v: str) -> bool:
    data = _decoded(v)
    s = _text(data) if data else None
    return bool(s) and ":" in s and not STAND_IN.fullmatch(s.split(":", 1)[1]) and len(s.split(":", 1)[1]) >= 4


def _regions(text: str) -> list[tuple[int, int, int]]:
    """(start, end of line, end with two more lines that aren't blank) of each line on which a pattern can begin: it holds a hint, or a literal that is continued."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if not text.isascii():
        for letter, other in ALIKE.items():
            low = low.replace(letter, other)
    starts = set()
    for where, hints in ((low, HINTS), (text, EXACT)):
        for hint in hints:
            at = where.find(hint)
            while at >= 0:
                starts.add(where.rfind("\n", 0, at) + 1)
                end = where.find("\n", at)
                if end < 0:
                    break
                at = where.find(hint, end)
    starts.update(text.rfind("\n", 0, m.start()) + 1 for m in CONTINUED.finditer(text))
    out = []
    for start in sorted(starts):
        far = end = len(text) if (end := text.find("\n", start)) < 0 else end
        more = 2
        while more and far < len(text):
            nxt = len(text) if (nl := text.find("\n", far + 1)) < 0 else nl
            more -= not text[far:nxt].isspace()
            far = nxt
        out.append((start, end, far))
    return out


def _joined(text: str, m: re.Match) -> tuple[str, list[tuple[int, int]]]:
    """The value of a quoted match with the literals that continue it, and the pieces' spans."""
    value, spans, at = m["v"], [m.span("v")], m.end()
    while piece := PIECES.match(text, at):
        value, at = value + piece[2], piece.end()
        spans.append(piece.span(2))
    return value, spans


def _contextual(text: str, start: int, end: int, far: int, add, inside) -> None:
    """What the patterns find on one line."""
    for m in PROVIDER.finditer(text, start, end):
        if not MASKED.search(m[0]) and not inside(m.start()):
            add("token", m.span())
    for m in ASSIGN.finditer(text, start, far):
        if m.start() > end:
            break
        if m["v"] is not None:
            value, spans = _joined(text, m)
            if literal(value, True) and (len(spans) == 1 or text[m.start() : spans[0][0]].find("(") >= 0 or "+" in text[spans[0][1] : spans[-1][0]] or "\n" not in text[spans[0][1] : spans[-1][0]]):
                add("password" if "pass" in m[0].lower() or "pwd" in m[0].lower() else "secret", *spans)
        elif literal(m["u"], False) and "\n" not in text[m.start() : m.start("u")].rstrip("\n")[-1:]:
            add("secret", m.span("u"))
    for pattern, kind in ((MARKUP, "secret"), (DEFAULT, "secret"), (QUERY, "token"), (CALL, "password")):
        for m in pattern.finditer(text, start, end):
            group = "v" if m["v"] is not None else "w"
            if literal(m[group], True):
                add(kind, m.span(group))
    for m in URL.finditer(text, start, end):
        v = unquote(m["v"])
        if len(v) >= 5 and not STAND_IN.fullmatch(v) and not MASKED.search(v) and not re.match(r"\d+/|\{|\$|%[(sd]", v) and not m["u"].startswith(("{", "$")):
            add("url_login", m.span("v"))
    for m in HEADER.finditer(text, start, end):
        scheme, group = (m["s"], "v") if m["v"] else (m["t"], "w") if m["w"] else ("key", "x")
        v = m[group].rstrip(".,;")
        if (scheme.lower() == "basic" and _basic(v)) or (scheme.lower() != "basic" and literal(v, True)):
            add("header", (m.start(group), m.start(group) + len(v)))
    for m in COMMAND.finditer(text, start, end):
        group = next(g for g in "vwx" if m[g])
        v = m[group].rstrip(",;")
        if literal(v, True):
            add("command", (m.start(group), m.start(group) + len(v)))
    for m in PROSE.finditer(text, start, end):
        v = m["v"].rstrip(".。!?)")
        if strong(v):
            add("prose", (m.start("v"), m.start("v") + len(v)))


def scan(text: str | None, layers: int | None = MAX_LAYERS) -> list[Finding]:
    """All credential literals of a text in order of position."""
    if not text or not text.strip():
        return []
    found: dict[int, Finding] = {}

    def add(kind: str, *spans: tuple[int, int]) -> None:
        found.setdefault(spans[0][0], Finding(spans[0][0], kind, spans))

    blocks = []
    if "PRIVATE KEY" in text:
        for m in PEM.finditer(text):
            if armoured(m[2]):
                blocks.append(m.span())
                found[m.start()] = Finding(m.start(), "private_key", (m.span(2),))
    if "-----BEGIN" in text:
        blocks += [m.span() for m in re.finditer(r"-----BEGIN (?:CERTIFICATE|[A-Z ]*PUBLIC KEY)-----.*?(?:-----END [A-Z ]+-----|\Z)", text, re.S)]

    def inside(at: int) -> bool:
        return any(a <= at < b for a, b in blocks)

    held: list[Held] = []
    joined = 0
    for start, end, far in _regions(text):
        _contextual(text, start, end, far, add, inside)
        line = text[start:end]
        if joined < end and ('"' in line or "'" in line):
            joined = _split_strings(text, max(start, joined), end, far, layers, add, held)
    if layers is None or layers > 0:
        _encoded(text, layers and layers - 1, add, inside, found, held)
        if held:
            _in_place(text, held, add)
    taken: list[Finding] = []
    for f in sorted(found.values(), key=lambda f: (f.start, -f.spans[-1][1])):
        if (not taken or f.start >= taken[-1].spans[-1][1]) and not (f.kind != "private_key" and inside(f.start)):
            taken.append(f)
    return taken


#: The end of a literal that is continued, as ``MORE`` has it.
CONTINUED = re.compile(r"[\"'](?:\s*\+|[ \t]*\n[ \t]*[bBrRuUfF]{0,2}[\"'])")
MORE = re.compile(r"([\"'])((?:(?!\1)[^\\\n])+)\1(?=\s*\+|[ \t]*\n[ \t]*[bBrRuUfF]{0,2}[\"'][^\"'\n])")


def _split_strings(text: str, start: int, end: int, far: int, layers: int | None, add, held: list[Held]) -> int:
    """Literals put together from pieces: what only shows in the joined text is found at the first piece. Returns where the last one ends."""
    at = start
    while (m := MORE.search(text, at, far)) and m.start() < end:
        pieces, nxt = [m.span(2)], m.end()
        while p := PIECES.match(text, nxt):
            pieces.append(p.span(2))
            nxt = p.end()
        at = nxt
        if len(pieces) < 2:
            continue
        joined, edges = "", []
        for a, b in pieces:
            edges.append(len(joined))
            joined += text[a:b]
        alone = {text[a:b][x.spans[0][0] : x.spans[-1][1]] for a, b in pieces for x in scan(text[a:b], layers)}
        spans = []
        whole = [f.spans for f in scan(joined, layers)]
        if not whole and (values := list(_unwrapped(joined))):
            held.append(Held(pieces[0][0], pieces[-1][1], "split", ((pieces[0][0], pieces[0][0]), *pieces), values))
        for found in whole:
            if joined[found[0][0] : found[-1][1]] in alone:
                continue
            for a, b in found:
                for (pa, pb), e in zip(pieces, edges):
                    lo, hi = max(a, e), min(b, e + pb - pa)
                    if lo < hi:
                        spans.append((pa + lo - e, pa + hi - e))
        if spans:
            add("split", (pieces[0][0], pieces[0][0]), *spans)
    return at


def _plain_layer(v: str) -> str | None:
    """The text that a whole value encodes."""
    if re.fullmatch(r"[A-Za-z0-9+/_-]{4,}={0,2}", v):
        data = bytes.fromhex(v) if re.fullmatch(r"(?:[0-9a-f]{2})+|(?:[0-9A-F]{2})+", v) else _decoded(v)
        return _text(data) if data else None
    if "%" in v and (s := unquote(PERCENTS.sub("%", v))) != v:
        return s
    if "\\" in v and (s := _unescaped(v)) != v:
        return s
    return None


def _unescaped(v: str) -> str:
    return re.sub(r"\\x([0-9a-fA-F]{2})|\\u([0-9a-fA-F]{4})", lambda x: chr(int(x[1] or x[2], 16)), v)


def _unwrapped(v: str):
    """The texts under a value's layers, outermost first."""
    while (v := _plain_layer(v.strip())) is not None:
        yield v


class Held(NamedTuple):
    """A literal that encodes ``values``, none of which is a credential by itself."""

    start: int
    end: int
    kind: str
    spans: tuple[tuple[int, int], ...]
    values: list[str]


def _in_place(text: str, held: list[Held], add) -> None:
    """Judge decoded values where their literals stand: under their names, in their calls or markup, without calls that decode them."""
    held = [h._replace(values=[v for x in h.values if len(v := x.strip()) >= 4 and not re.search(r"\s", v)]) for h in {h[:2]: h for h in reversed(held)}.values()]
    while held := [h for h in held if h.values]:
        held.sort(key=lambda h: (h.start, -h.end))
        now, later, edge = [], [], 0
        for h in held:
            if h.start < edge:
                later.append(h)
            else:
                now.append(h)
                edge = h.end
        parts, places, at, size = [], [], 0, 0
        for h in now:
            head, value, at = text[at : h.start], h.values[0], h.end
            if head.endswith(("'", '"')):
                mark = head[-1]
                head = head.rstrip(mark)
                while text.startswith(mark, at):
                    at += 1
                if re.search(r"(?<!\w)[bBrRuUfF]{1,2}\Z", head[-3:]):
                    head = head.rstrip("bBrRuUfF")
                while (cut := head.rstrip()).endswith("("):
                    k = len(cut) - 1
                    while k and (cut[k - 1].isalnum() or cut[k - 1] in "_."):
                        k -= 1
                    head = cut[:k]
                quote = next((q for q in ('"', "'") if q not in value), '"""')
                value = quote + value + quote
            head = SUFFIX.sub("", head)
            parts += [head, value]
            places.append((size + len(head), size + len(head) + len(value)))
            size = places[-1][1]
        changed, hits = "".join(parts) + text[at:], []
        starts = [a for a, _ in places]
        for start, end, far in _regions(changed):
            k = bisect_left(starts, far)
            if k and places[k - 1][1] > start:
                _contextual(changed, start, end, far, lambda kind, *spans: hits.extend(spans), lambda _: False)
        hit = set()
        for a, b in hits:
            k = bisect_left(starts, b)
            while k and places[k - 1][1] > a:
                k -= 1
                hit.add(k)
        for k, h in enumerate(now):
            if k in hit:
                add(h.kind, *h.spans)
            else:
                later.append(h._replace(values=h.values[1:]))
        held = later


def _wrapped(text: str):
    """Runs that go on over several lines of one width, a shorter one last: (spans of the lines, all characters)."""
    at = 0
    while m := WRAPPED.search(text, at):
        spans, width, at = [m.span()], len(m[0]), m.end()
        while (w := WRAP.match(text, at)) and (p := WRAPPED_LINE.match(text, w.end())) and len(p[0]) <= width:
            spans.append(p.span())
            at = p.end()
            if len(p[0]) < width or p[0].endswith("="):
                break
        if len(spans) > 1:
            yield spans, "".join(text[a:b] for a, b in spans)
            if len(spans) > 2:
                yield spans[:-1], "".join(text[a:b] for a, b in spans[:-1])


def _may_decode(run: str) -> bool:
    return run.isalnum() and (run.lower() == run or run.isupper()) or bool(re.search(r"[a-z]", run) and re.search(r"[A-Z]", run))


def _encoded(text: str, layers: int | None, add, inside, found, held: list[Held]) -> None:
    """Literals that hold a credential under base64, hex, percent or backslash layers; ``layers`` more may be opened below."""

    def holds(s: str, kind: str, *spans: tuple[int, int]) -> bool:
        if scan(s, layers):
            return True
        held.append(Held(spans[0][0], spans[-1][1], kind, spans, [s, *_unwrapped(s)]))
        return False

    covered: list[tuple[int, int]] = []
    for spans, run in _wrapped(text):
        a, b = spans[0][0], spans[-1][1]
        if inside(a) or covered and a < covered[-1][1] or not _may_decode(run) or text[max(0, a - 8) : a].endswith("base64,") or not (data := _decoded(run)):
            continue
        if container(data):
            found[a] = Finding(a, "private_key", tuple(spans))
        elif (s := _text(data)) and holds(s, "encoded", *spans):
            found[a] = Finding(a, "encoded", tuple(spans))
        else:
            continue
        covered.append((a, b))
    for m in RUN.finditer(text):
        run = m[0]
        if m.start() in found or inside(m.start()) or text[max(0, m.start() - 8) : m.start()].endswith("base64,"):
            continue
        if not _may_decode(run) or any(a <= m.start() < b for a, b in covered):
            continue
        data = _decoded(run)
        if not data:
            continue
        if container(data):
            add("private_key", m.span())
        elif (s := _text(data)) and holds(s, "encoded", m.span()):
            add("encoded", m.span())
    if any(name in text for name in DECODERS):
        for m in DECODER.finditer(text):
            if m.start("v") not in found and not inside(m.start()):
                held.append(Held(*m.span("v"), "encoded", (m.span("v"),), list(_unwrapped(m["v"]))))
    if "%" in text:
        for m in PERCENT.finditer(text):
            start = m.start()
            while start and (text[start - 1].isalnum() or text[start - 1] in "._~+/:;@-"):
                start -= 1
            if start not in found and not inside(start) and holds(unquote(PERCENTS.sub("%", text[start : m.end()])), "encoded", (start, m.end())):
                add("encoded", (start, m.end()))
    if "\\x" in text or "\\u" in text:
        for m in BACKSLASH.finditer(text):
            s = _unescaped(m[0])
            if strong(s) or holds(s, "encoded", m.span()):
                add("encoded", m.span())


def redact(text: str | None, layers: int | None = MAX_LAYERS) -> str | None:
    """The text with each credential replaced by ``REDACTED_<KIND>``; everything else, line structure included, is untouched."""
    return redacted_as(text, scan(text, layers))


def redacted_as(text: str | None, findings: list[Finding]) -> str | None:
    if not findings:
        return text
    out, at = [], 0
    for f in findings:
        spans = [s for s in f.spans if s[1] > s[0]]
        for i, (a, b) in enumerate(spans):
            if a < at:
                continue
            out.append(text[at:a])
            if f.kind == "private_key":
                out.append(re.sub(r"[A-Za-z0-9+/=]+", "REDACTED", text[a:b]) if "\n" in text[a:b] else "REDACTED_PRIVATE_KEY")
            else:
                out.append(f"REDACTED_{f.kind.upper()}" if i == 0 else "")
            at = b
    out.append(text[at:])
    return "".join(out)


def _lines(text: str, findings: list[Finding]) -> list[tuple[int, str]]:
    seen: dict[int, str] = {}
    at = line = 0
    for f in findings:
        line += text.count("\n", at, f.start)
        at = f.start
        seen.setdefault(line + 1, f.kind)
    return list(seen.items())


def find(df: DataFrame, id_col: str, text_col: str, layers: int | None = MAX_LAYERS) -> DataFrame:
    """(id, line_no, kind): one row per line on which a credential begins. Map-only: no shuffle, one pass over the text."""

    def batch(ids, texts):
        out = {"id": [], "line_no": [], "kind": []}
        for i, t in zip(ids, texts):
            if t:
                for line, kind in _lines(t, scan(t, layers)):
                    out["id"].append(i)
                    out["line_no"].append(line)
                    out["kind"].append(kind)
        return out

    return map_columns(df, [id_col, text_col], batch, "id bigint, line_no int, kind string")


def find_in_messages(df: DataFrame, id_col: str, messages_col: str, layers: int | None = MAX_LAYERS) -> DataFrame:
    """(id, msg_idx, line_no, kind) over an array of (role, content) turns."""

    def batch(ids, all_messages):
        out = {"id": [], "msg_idx": [], "line_no": [], "kind": []}
        for i, messages in zip(ids, all_messages):
            for k, m in enumerate(messages or []):
                if m and m["content"]:
                    for line, kind in _lines(m["content"], scan(m["content"], layers)):
                        for name, v in zip(out, (i, k, line, kind)):
                            out[name].append(v)
        return out

    return map_columns(df, [id_col, messages_col], batch, "id bigint, msg_idx int, line_no int, kind string")


def redacted(df: DataFrame, id_col: str, text_col: str, layers: int | None = MAX_LAYERS) -> DataFrame:
    """(id, text, n_found): each row's text with its credentials replaced; null stays null."""

    def batch(ids, texts):
        found = [scan(t, layers) for t in texts]
        return {"id": ids, "text": [redacted_as(t, f) for t, f in zip(texts, found)], "n_found": [len(f) for f in found]}

    return map_columns(df, [id_col, text_col], batch, "id bigint, text string, n_found int")


def redacted_messages(df: DataFrame, id_col: str, messages_col: str, layers: int | None = MAX_LAYERS) -> DataFrame:
    """(id, messages): the turns with credentials replaced; roles, order and null contents stay."""

    def batch(ids, all_messages):
        out = [None if ms is None else [m and {"role": m["role"], "content": redact(m["content"], layers)} for m in ms] for ms in all_messages]
        return {"id": ids, "messages": out}

    return map_columns(df, [id_col, messages_col], batch, "id bigint, messages array<struct<role:string,content:string>>")


def p1_found(docs: DataFrame, chats: DataFrame) -> DataFrame:
    files = find(docs, "file_id", "content").select(F.lit("source_docs").alias("tbl"), F.col("id").alias("rec_id"), F.lit(-1).alias("msg_idx"), "line_no")
    turns = find_in_messages(chats, "record_id", "messages").select(F.lit("chat_records").alias("tbl"), F.col("id").alias("rec_id"), "msg_idx", "line_no")
    return files.unionByName(turns)
