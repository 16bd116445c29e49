"""Problem 10: personal information inside free text.

Entities of five kinds are detected by form and context. Each gets a keyed surrogate that matches its type, script, format and (for
given names) gender reading: digits and letters of numbers go through a keyed permutation of their own format, so different originals
can't meet; names, addresses and e-mail addresses are drawn from a keyed space, share no word or number with their original, and a
check over the corpus' distinct entities moves those that meet on to their next value. The text as the task wants it holds typed
placeholders that carry the entity's key (``[EMAIL:3f9c...]``), so that equal originals stay recognisable as equal;
``mode="surrogate"`` puts the surrogates in place.

Defined results: null stays null; empty and blank texts have no entities and come back unchanged; everything outside the entities
keeps its characters; repeated rows are treated alike; whole texts are scanned.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import map_columns, materialize

#: Kinds whose surrogates are a permutation of their format.
PERMUTED = ("phone", "identity_number")
KINDS = ("email", "street_address", "identity_number", "phone", "name")
#: Entities that the driver may hold because their first surrogate is another entity's.
MOST_EXCEPTIONS = 100_000


class Entity(NamedTuple):
    start: int
    end: int
    kind: str


EMAIL = re.compile(r"(?<![\w.+-])[\w][\w.+'-]*@(?=[\w-]+\.)[A-Za-z0-9][\w-]*(?:\.[\w-]+)*\.[A-Za-z]{2,}(?![\w@])")
SPELT = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*\s*(?:\[at\]|\(at\)|\{at\}|<at>|\s(?:AT|at|arroba|chez|골뱅이)\s)\s*[A-Za-z0-9][\w-]*(?:\s*(?:\[dot\]|\(dot\)|\{dot\}|\s(?:DOT|dot|punto|point|punkt|점)\s|\.)\s*[A-Za-z0-9-]+)+", 0
)
# What stands before an address that belongs to a repository or a machine, not to a person.
REMOTE_USERS = re.compile(r"(?i)^(?:git|hg|svn|root|runner|deploy|ubuntu|ec2-user|noreply|no-reply|postmaster|admin)$")
REMOTE_BEFORE = re.compile(r"(?:ssh|scp|sftp|rsync|git\s+clone|clone it from|://)\s*(?:-\w+\s+\S+\s+)*(?:[\w.+-]+:)?$", re.I)
TLD = re.compile(r"\.(?:example|test|invalid|com|org|net|io|dev|de|fr|es|kr|jp|cn|uk|eu|edu|gov|info|co|app|me|ch|at|us)$", re.I)

PHONE = re.compile(
    r"(?<![\w.+/-])(?:"
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}"
    r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}"
    r"|\d{3}([.-])\d{3}\1\d{4}"
    r"|\d{3} \d{3} \d{4}"
    r"|\+44[ .-]?\(?0?\)?[ .-]?\d{2,5}[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|0\d{3,4} \d{3,4} ?\d{3,4}|020 \d{4} \d{4}"
    r"|\+82[ .-]?\d{1,2}[ .-]\d{3,4}[ .-]\d{4}|01[016789][ .-]\d{3,4}[ .-]\d{4}|0\d{1,2}-\d{3,4}-\d{4}"
    r"|\+49[ ./-]?\(?0?\)?[ ./-]?\d{2,4}[ ./-]*\d{3,8}(?:[ -]\d{1,6})?|\(0\d{2,4}\)[ ./-]*\d{3,8}(?:[ -]\d{1,6})?|0\d{2,4} ?/ ?\d{3,8}(?:[ -]\d{1,6})?"
    r"|\+33[ .-]?\(?0?\)?[ .-]?\d(?:[ .-]?\d{2}){4}|0\d(?:[ .]\d{2}){4}"
    r"|\+34[ .-]?\d{3}[ .-]?\d{2,3}[ .-]?\d{2,3}(?:[ .-]?\d{2})?"
    r"|\+81[ .-]?\d{1,4}[ .-]\d{1,4}[ .-]\d{4}|\+86[ .-]?1\d{2}[ .-]?\d{4}[ .-]?\d{4}"
    r"|\+\d{1,3}[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){2,4}"
    r")(?:(?:\s*(?:x|ext\.?|;ext=)\s*)\d{1,5})?(?![\w]|[.-]\d)"
)
# Words in front of a number that is no phone although it looks like one.
NOT_PHONE = re.compile(r"(?i)(?:version|build|ticket|issue|catalogue number|isbn|port(?:s| range)?|offset|timestamp|row|id|#|line|tiles|v|commit|order|invoice|matrix shape)\s*(?:no\.?|number|[#:=])?\s*$")
PHONE_WORD = re.compile(r"(?i)(?:tel|phone|call|fax|mobil|mobile|number|reach|teléfono|móvil|joignable|telefon|telefonisch|전화|연락|電話|电话|contact)\W*\w{0,12}\W*(?:\w{1,5}\W+){0,2}$")

SSN = re.compile(r"(?<![\w-])\d{3}[- ]\d{2}[- ]?\d{4}(?![\w-])")
RRN = re.compile(r"(?<![\w-])\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])-[1-8]\d{6}(?![\w-])")
NINO = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z](?![A-Za-z0-9])")
DNI = re.compile(r"(?<![A-Za-z0-9])(?:\d{8}-?[A-Z]|[XYZ]-?\d{7}-?[A-Z])(?![A-Za-z0-9])")
PASSPORT = re.compile(r"(?<![A-Za-z0-9])(?:[A-Z]{1,2}\d{6,8}|\d{9}|[A-Z]\d{2}[A-Z0-9]{6})(?![A-Za-z0-9])")
NIR = re.compile(r"(?<!\d)[12] ?\d{2} ?(?:0[1-9]|1[0-2]) ?\d{2} ?\d{3} ?\d{3}(?: ?\d{2})?(?!\d)")
TAXID = re.compile(r"(?<![\w-])(?:\d{2}[- ]\d{7}|\d{2} ?\d{3} ?\d{3} ?\d{3}|\d{11}|\d{12}|\d{4} \d{4} \d{4}|\d{17}[\dX])(?![\w-])")
ID_WORD = re.compile(
    r"(?i)(?:\bssn\b|social(?: security)?(?: (?:number|no\.?|insurance))?|tax(?:payer)? ?(?:id|no\.?|number)|\btin\b|\bitin\b|national insurance|\bni (?:number|no)|\bnino\b|passport|\breisepass|personalausweis|ausweis|steuer-?(?:id|nummer)|sozialversicherung"
    r"|\bdni\b|\bnie\b|\bnif\b|pasaporte|seguridad social|\bnir\b|sécurité sociale|\bsécu\b|passeport|carte d'identité|주민(?:등록)?번호|여권|외국인등록|マイナンバー|個人番号|旅券|パスポート|身份证|护照|社保|national id|id card|identity (?:card|number)|driver'?s licen[cs]e)"
)

# Parts of which any word of ``ID_WORD`` holds one.
ID_HINTS = (
    "ssn", "social", "tax", "tin", "insurance", "ni n", "nino", "pass", "ausweis", "steuer", "sozial", "dni", "nie", "nif", "pasaporte", "seguridad", "nir", "sécu", "identit", "주민", "여권", "외국인", "マイナンバー", "個人番号", "旅券",
    "パスポート", "身份", "护照", "社保", "national id", "id card", "driver",
)

STREET_EN = r"(?:Street|St\.?|Avenue|Ave\.?|Road|Rd\.?|Lane|Ln\.?|Drive|Dr\.?|Boulevard|Blvd\.?|Court|Ct\.?|Place|Pl\.?|Way|Terrace|Crescent|Square|Close|Grove|Hill|Row|Walk|Parkway|Highway)"
ADDRESS = tuple(
    re.compile(p)
    for p in (
        rf"(?<![\w.#-])\d{{1,5}}[A-Za-z]? (?:[A-Z][\w'’]+\.? ){{1,4}}{STREET_EN}(?![\w])(?:(?:,? |\n)(?:Apt|Flat|Unit|Suite|Apartment)\.?\s*#?\d+\w?)?(?:(?:, ?|,?\n(?=[A-Z][a-z]+(?: [A-Z][a-z]+)?(?:,|,?\n[A-Z\d]\d| [A-Z]\d|\n*$)))[A-Z][a-z'’-]+(?: [A-Z][a-z'’-]+){{0,2}}(?:(?:, ?|,?\n)\d{{5}}(?:-\d{{4}})?|[ \n][A-Z]{{1,2}}\d{{1,2}}[A-Z]? ?\d[A-Z]{{2}})?)?",
        r"(?<!\w)(?:[A-ZÄÖÜ][\wäöüß-]*(?:straße|strasse|str\.|gasse|weg|allee|platz|ring|damm|ufer|steig|stieg|pfad|chaussee|markt|hof)|(?:Am|An der|An den|Im|In der|Auf dem|Auf der|Zum|Zur|Unter den|Alte[rn]?|Neue[rn]?|Große|Kleine)\s+[A-ZÄÖÜ][\wäöüß-]+(?:straße|weg|allee|platz)?)\s+\d{1,4}\s?[a-z]?(?!\w|[.,:]\d)(?:,\s*(?:D-)?\d{5}\s+[A-ZÄÖÜ][\wäöüß-]+(?:\s+[A-ZÄÖÜ][\wäöüß-]+)?)?",
        r"(?<!\w)\d{1,4}(?:\s?(?:bis|ter|quater))?,?\s+(?:rue|avenue|boulevard|bd|av\.|chemin|impasse|place|allée|quai|route|passage|square|cours|sentier|ruelle|montée)\s+(?:(?:de la |de l'|des |du |de |d'|l'|la |le |les )?[A-ZÀÂÉÈÊÎÔÛ0-9][\w'’àâéèêëîïôûç-]*\s?){1,5}(?<=\w)(?:,\s*\d{5}\s+[A-ZÉ][\w'’éèê-]+(?:\s+[A-ZÉ][\w'’éèê-]+)?)?",
        r"(?<!\w)(?:Calle|C/|Avenida|Avda\.?|Av\.|Plaza|Paseo|Pº|Camino|Carretera|Ronda|Travesía|Glorieta|Rambla|calle|avenida|plaza|paseo)\s+(?:(?:de los |de las |de la |del |de |la |el |los |las )?[A-ZÁÉÍÓÚÑ][\wáéíóúñ'’-]*\s?){1,4},?\s*(?:n[.º°]*\s*)?\d{1,4}[A-Z]?(?!\d)(?:,\s*\d+\s?[º°ª](?:\s?[A-Z])?)?(?:,\s*(?:\d{5}\s+)?[A-ZÁÉÍÓÚÑ][\wáéíóúñ-]+)?",
        r"(?:[가-힣]{1,5}(?:특별시|광역시|특별자치시|시|도)\s+)?(?:[가-힣]{1,5}(?:시|군|구)\s+){0,2}(?<![가-힣])[가-힣0-9]{1,8}(?:대로|로|길)(?:\s?\d{1,4}(?:번)?길)?\s+\d{1,4}(?:-\d{1,4})?(?![\d번])(?:,?\s*(?:지하\s*)?\d{1,4}(?:층|호|동)(?:\s?\d{1,4}호)?)?",
        r"(?:[一-鿿]{2,4}[都道府県])?[一-鿿ぁ-んァ-ヶ]{1,8}[市区町村郡][一-鿿ぁ-んァ-ヶ]{1,8}\d{1,3}(?:丁目\d{1,3}番(?:地)?(?:\d{1,3}号)?|-\d{1,3}(?:-\d{1,3})?)",
        r"(?:[一-鿿]{2,6}[省市区县])?[一-鿿]{1,8}(?:路|街|大道|巷|胡同)\d{1,5}号(?:\d{1,4}[室栋楼])?",
    )
)

ENDINGS_DE = ("straße", "strasse", "str.", "gasse", "weg", "allee", "platz", "ring", "damm", "ufer", "steig", "stieg", "pfad", "chaussee", "markt", "hof")
STANDS_BEFORE_DE = re.compile(r"(?:Am|An der|An den|Im|In der|Auf dem|Auf der|Zum|Zur|Unter den|Alte[rn]?|Neue[rn]?|Große|Kleine)\s+[A-ZÄÖÜ][\wäöüß-]*$")


def before_number_de(before: str) -> bool:
    """Whether a street's name, or the end of a long one, stands in front of a number."""
    return before.endswith(ENDINGS_DE) or bool(STANDS_BEFORE_DE.search(before)) or len(before) == 60 and not re.search(r"\s", before[20:])


#: What a text must hold for an address of the same place in ``ADDRESS``: parts of the pattern that are quickly looked for.
ADDRESS_GATES = (
    re.compile(r"\d[A-Za-z]? [A-Z]").search, lambda text: any(before_number_de(text[max(0, m.start() - 60) : m.start()]) for m in re.finditer(r"(?<=[\wäöüß.])\s+\d", text)), re.compile(r"\d(?:\s?(?:bis|ter|quater))?,?\s+(?:rue|avenue|boulevard|bd|av\.|chemin|impasse|place|allée|quai|route|passage|square|cours|sentier|ruelle|montée)\s").search,
    re.compile(r"(?:Calle|C/|Avenida|Avda|Av\.|Plaza|Paseo|Pº|Camino|Carretera|Ronda|Travesía|Glorieta|Rambla|calle|avenida|plaza|paseo)").search,
    re.compile("[로길] ?[0-9]").search, re.compile("[市区町村郡].{0,12}[0-9]").search, re.compile("[路街道巷同][0-9]").search,
)
#: A run with so many digits and separators that it may be a phone or identity number.
ID_NUMBER = re.compile(r"\d{6}|\d\d ?\d\d ?\d\d|[A-Z]\d\d[A-Z0-9]{6}|[XYZ]-?\d")
LONG_NUMBER = re.compile(r"\d[\d .()/-]{5,}\d")

# Capitalised pairs of products and methods.
NOT_NAMES = frozenset(
    "random forest|monte carlo|visual studio|gaussian process|hidden markov|data layer|docker compose|apache beam|apache spark|street view|fast lane|lane detection|road segmentation|stack overflow|google cloud|machine learning|deep learning|neural network|open source|pull request|merge request|read only|viele grüße|best regards|kind regards|san francisco|new york|hello world|user id|all rights".split("|")
)
PART = r"[A-ZÀ-ÖØ-ÞŁŚŽČŠ][a-zà-öø-ÿłńśžčšěřůı]+(?:['’](?!s\b)[A-ZÀ-Þ]?[a-zà-öø-ÿ]+)?"
GIVEN = rf"{PART}(?:-{PART})?"
FAMILY = rf"(?:(?:van|von|de|di|da|del|della|der|den|le|la|Mc|Mac|O['’])\s?)*{PART}(?:-{PART})?"
TITLE = r"(?:(?:Mr|Mrs|Ms|Mx|Dr|Prof|Herr|Frau|Sr|Sra|Mme|M)\.?\s+)"
FULL = rf"(?:(?P<g>{GIVEN})(?:\s+[A-Z]\.)*\s+(?P<f>{FAMILY})|(?P<f2>{FAMILY}),\s+(?P<g2>{GIVEN})(?:\s+[A-Z]\.)?)"
# Contexts that introduce a person, in the corpus languages.
BEFORE = (
    r"(?:Signed-off-by|Co-authored-by|Reviewed-by|Acked-by|Tested-by|Reported-by|Suggested-by|[Aa]uthor|[Mm]aintainer|[Aa]ssignee|[Oo]wner|[Rr]eviewer|[Cc]ontact|[Ff]rom|[Tt]o|[Cc][Cc]|작성자|담당자|이름|성명|担当者?|作者|姓名|氏名|联系人|名前|Nom|Nombre|Name|Autor(?:in)?|Auteur|Ansprechpartner(?:in)?)\s*[\"']?\s*[:=：]\s*[\"']?"
    r"|\b(?:cc|[Rr]eported by|[Ff]ound by|[Ff]ixed by|[Ww]ritten by|[Rr]eviewed by|[Ss]uggested by|[Aa]ssigned to:?|[Tt]alked to|[Ss]poke (?:to|with)|[Tt]hanks to|[Tt]hank you,?|[Aa]sk|[Pp]ing|[Hh]i|[Hh]ello|[Dd]ear|[Hh]allo|[Hh]ola|[Bb]onjour|As|[Cc]redit to|[Dd]anke an|[Gg]emeldet (?:wurde das )?von|[Vv]on|[Mm]erci à|[Ss]ignalé par|[Pp]ar|[Ll]o comentó|[Gg]racias a|[Ss]aludos,?|[Gg]rüße,?|[Cc]ordialement,?|[Rr]egards,?|[Cc]heers,?|[Bb]est,?|[Mm]y name is|I am|[Ii]ch bin|[Mm]e llamo|[Jj]e m'appelle)\s+"
    r"|(?:^|(?<=[\s|]))(?:--|—|–)\s+|\|\s*|담당자는\s*|작성자는\s*|(?:連絡先|担当)は\s*"
)
PAIR = re.compile(rf"(?<![\w-]){FULL}(?![A-Za-zÀ-ÿ0-9_-])")
TITLED = re.compile(rf"(?<!\w){TITLE}$")
INTRODUCED = re.compile(rf"(?:{BEFORE}){TITLE}?$", re.M)
#: Characters before a pair in which its context begins.
REACH = 60
FOLLOWED = re.compile(
    r"(?:['’]s\s+\w+|\s+(?:wrote|said|pointed out|reported|suggested|asked|noted|mentioned|confirmed|fixed|merged|reviewed|found|told|agreed|schrieb|sagte|meinte|hat\s|escribió|dijo|comentó|a\s+(?:écrit|signalé|dit))|\s+<|\s*(?:님|씨|さん|様|先生|女士|입니다|です)|\s*,?\s*\|)"
)
SURNAMES_KO = "제갈|남궁|황보|선우|사공|서문|독고|동방|김|이|박|최|정|강|조|윤|장|임|한|오|서|신|권|황|안|송|전|홍|유|고|문|양|손|배|백|허|남|심|노|하|곽|성|차|주|우|구|민|류|나|진|지|엄|채|원|천|방|공|현|함|변|염|여|추|도|소|석|선|설|마|길|연|위|표|명|기|반|왕|금|옥|육|인|맹|제|모|탁|국|어|은|편|용|예|경|봉|사|부|가|복|태|목|형|피|두|감|음|빈|동|온|호|범|좌|팽|승|간|상|시|갈|단|견|당"
NAME_KO = re.compile(
    r"(?<![가-힣])(?P<k>[가-힣]{3,5})(?= ?(?:님|씨)(?:이|께|은|는|가|의|,|\b)(?![가-힣]))"
    r"|(?:담당자|작성자|이름|성명|보고자|검토자)(?:는|은|:|：)?\s*(?P<k2>[가-힣]{3,5}?)(?=\s*(?:입니다|이에요|예요|님|씨|$|[.,;)\s]))",
    re.M,
)
SURNAME_KO = re.compile(f"(?:{SURNAMES_KO})[가-힣]{{2}}|(?:제갈|남궁|황보|선우|사공|서문|독고|동방)[가-힣]{{1,2}}")
NAME_CJK = re.compile(r"(?:担当者?|作者|姓名|氏名|联系人|名前|報告者|负责人|报告人)(?:は|是|:|：)\s*(?P<c>[一-鿿]{2,4}(?:[ 　][一-鿿]{1,3})?)(?=です|さん|様|。|，|,|\s|$)|(?P<c2>[一-鿿]{2,4})(?=さん|様|先生|女士)", re.M)
# Articles, after which a capitalised pair names a thing.
ARTICLE = re.compile(r"(?i)(?<!\w)(?:the|a|der|die|das|den|dem|ein|eine|le|la|les|un|une|el|los|las|una)\s$")
CODE = re.compile(r"```.*?(?:```|\Z)", re.S)


def entities(text: str | None) -> list[Entity]:
    """Entities of a text in order, without overlaps; the longer one wins."""
    if not text or not text.strip():
        return []
    found: list[Entity] = []
    if "@" in text:
        for m in EMAIL.finditer(text):
            user, host = m[0].rsplit("@", 1)
            before = text[max(0, m.start() - 40) : m.start()]
            after = text[m.end() : m.end() + 2]
            if REMOTE_USERS.match(user) or REMOTE_BEFORE.search(before) or not TLD.search(host) or re.match(r":[\w/~]|[(/]", after):
                continue
            found.append(Entity(m.start(), m.end(), "email"))
    low = text.lower()
    if any(x in low for x in ("at]", "at)", "at}", "<at>", "arroba", "골뱅이")) or ("dot" in low or "punto" in low) and (" at " in low or " chez " in low):
        for m in SPELT.finditer(text):
            spelt = re.sub(r"\s*[\[({<]?(?:dot|punto|point|punkt|점)[\])}>]?\s*", ".", m[0], flags=re.I)
            if ("dot" in m[0].lower() or re.search(r"[\[({<]at[\])}>]", m[0], re.I) or "punto" in m[0] or "arroba" in m[0] or "골뱅이" in m[0]) and TLD.search(spelt.strip()):
                found.append(Entity(m.start(), m.end(), "email"))
    digits = any(c in "0123456789" for c in text)
    if digits:
        _numbers(text, found)
        for pattern, gate in zip(ADDRESS, ADDRESS_GATES):
            if gate(text):
                found += [Entity(m.start(), m.end(), "street_address") for m in pattern.finditer(text)]
    _names(text, found)
    order = {"email": 0, "street_address": 1, "identity_number": 2, "phone": 3, "name": 4}
    out: list[Entity] = []
    for e in sorted(found, key=lambda e: (e.start, -e.end, order[e.kind])):
        if not out or e.start >= out[-1].end:
            out.append(e)
        elif order[e.kind] < order[out[-1].kind] and e.end >= out[-1].end:
            out[-1] = e
    return out


def _numbers(text: str, found: list[Entity]) -> None:
    def named(start: int, reach: int = 70) -> bool:
        before = text[max(0, start - reach) : start].rsplit("\n", 1)[-1]
        return any(len(before) - m.end() <= 30 for m in ID_WORD.finditer(before))

    taken: list[tuple[int, int]] = []
    low = text.lower()
    long = LONG_NUMBER.search(text)
    stated = (long or ID_NUMBER.search(text)) and any(w in low for w in ID_HINTS)
    for pattern, free in (*(((RRN, True),) if long else ()), *(((SSN, False), (NINO, False), (DNI, False), (NIR, False), (PASSPORT, False), (TAXID, False)) if stated else ())):
        for m in pattern.finditer(text):
            if (free or named(m.start())) and not any(a < m.end() and m.start() < b for a, b in taken):
                taken.append(m.span())
                found.append(Entity(m.start(), m.end(), "identity_number"))
    if not long:
        return
    for m in PHONE.finditer(text):
        before = text[max(0, m.start() - 40) : m.start()].rsplit("\n", 1)[-1]
        if any(a < m.end() and m.start() < b for a, b in taken) or NOT_PHONE.search(before):
            continue
        if len(re.sub(r"\D", "", m[0])) < 9 or (m[0][0] not in "+(0" and not re.fullmatch(r"\d{3}[.-]\d{3}[.-]\d{4}.*", m[0]) and not PHONE_WORD.search(before)):
            continue
        found.append(Entity(m.start(), m.end(), "phone"))


def _names(text: str, found: list[Entity]) -> None:
    plain = CODE.sub(lambda m: " " * len(m[0]) if "\n" in m[0] else m[0], text) if "```" in text else text
    at = 0
    while m := PAIR.search(plain, at):
        g, f = ("g", "f") if m["g"] else ("g2", "f2")
        a, b = min(m.start(g), m.start(f)), max(m.end(g), m.end(f))
        at = a + len(re.match(r"\S+", m[0])[0])  # an overlapping pair may begin with this one's second word
        if f"{m[g]} {m[f]}".lower() in NOT_NAMES or m[g].lower() in STARTERS or m[f].lower() in STARTERS or ARTICLE.search(plain, max(0, a - 6), a):
            continue
        near = max(0, a - REACH)
        if INTRODUCED.search(plain, near, a) or TITLED.search(plain, near, a) or FOLLOWED.match(plain, m.end()):
            found.append(Entity(a, b, "name"))
            at = b
    if "님" in text or "씨" in text or "자" in text or "이름" in text or "성명" in text:
        for m in NAME_KO.finditer(plain):
            group = "k" if m["k"] else "k2"
            if SURNAME_KO.fullmatch(m[group]) and m[group] not in NOT_NAMES_KO:
                found.append(Entity(*m.span(group), "name"))
    if re.search(r"担当|作者|姓名|氏名|联系人|名前|者|さん|様|先生|女士|负责人|报告人", text):
        for m in NAME_CJK.finditer(plain):
            found.append(Entity(*m.span("c" if m["c"] else "c2"), "name"))


# Capitalised words that open sentences or name things, never a person's name.
STARTERS = frozenset(
    "mr mrs ms mx dr prof herr frau sr sra mme the this that these those when where what which who why how if use set please note some each every both only large small before after has nobody with without it its we you they he she i my our your rows returns as and or but not no yes for from to in on at by of is are was were do does read write thanks hi hello dear see add move street view random forest monte carlo visual studio gaussian process hidden markov data layer docker compose apache beam lane road avenue drive version build ticket catalogue error value type key index import file traceback most recent call last port ports drive pinned timestamp clone json http https api url todo fixme der die das ein eine wir sie ich el la los las un una le les une des du".split()
)
NOT_NAMES_KO = frozenset("손님 고객 주인 사용자 관리자 담당자 작성자 선생 부모 형 누 해 달".split())

# ---------------------------------------------------------------------------------------------------------------- surrogates
#: Syllables of invented words by script: every consonant with every vowel.
def _syllables(consonants: str, vowels: str) -> list[str]:
    return [c + v for c in consonants for v in vowels]


LATIN_SYLLABLES = _syllables("bdfghklmnprstvz", "aeio")
CYRILLIC_SYLLABLES = _syllables("бвгдзклмнпрст", "аеиоу")
# Letters that names are put together from in scripts without spaces; family names in front.
HANGUL_FAMILY = "감갈견단당두범부빈사상시음좌태팽피형호승"
HANGUL_GIVEN = "가나다라마바사아자차하고노도로모보소오주수우유기니리미비시은인선진현연영원윤정준지혜희호환"
HAN_FAMILY = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕"
HAN_GIVEN = "安宝春达恩芳光海和华吉佳建江洁金俊凯兰乐丽良林玲明宁平琴青清荣瑞山思松涛文武晓欣秀雪雅义英永玉云志"
KANA_LETTERS = "あいうえおかきくけこさしすせそたちつてとなにのはひふまみむめもやゆよらりるれわ"
# Endings of given names that read as female ones in most of the corpus languages.
FEMALE_ENDING = ("a", "e", "ie", "ine", "elle")
FEMALE = re.compile(r"(?i)(?:a|ie|ine|elle|ette|ys|een|lyn|beth|eth)$")
# Words and endings of addresses that name a kind of place, not a place.
PLACE_WORDS = frozenset(
    "street st avenue ave road rd lane ln drive dr boulevard blvd court ct place pl way terrace crescent square close grove hill row walk parkway highway apt flat unit suite apartment rue bd av chemin impasse allée quai route passage cours sentier ruelle montée bis ter quater de la le les l d du des"
    " calle c avenida avda plaza paseo pº camino carretera ronda travesía glorieta rambla del los las el n nº º ª am an der den im in dem auf zum zur unter alte alter alten neue neuer neuen große kleine".split()
)
PLACE_ENDING_DE = re.compile(r"(?i)(?:straße|strasse|str|gasse|weg|allee|platz|ring|damm|ufer|steig|stieg|pfad|chaussee|markt|hof)$")
PLACE_ENDING_KO = re.compile(r"(?:특별자치시|특별시|광역시|대로|번길|[시도군구로길번층호동])$")
PLACE_PART_HAN = re.compile(r"大道|胡同|丁目|番地|[省市区县都道府県町村郡路街巷号室栋楼番]")
ADDRESS_TOKEN = re.compile(r"(?P<n>[A-Za-z]*\d[A-Za-z0-9]*)|(?P<ko>[가-힣]+)|(?P<han>[一-鿿々]+)|(?P<kana>[ぁ-んァ-ヶー]+)|(?P<cy>[А-Яа-яЁё]+)|(?P<w>[^\W\d_]+)")


def _digest(secret: bytes, kind: str, value: str, salt: int = 0) -> int:
    return int.from_bytes(hmac.new(secret, f"{kind}\0{value}\0{salt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), "big")


def normal(kind: str, value: str) -> str:
    """What makes two mentions the same entity: form and case don't count, and ``Family, Given`` is ``Given Family``."""
    v = unicodedata.normalize("NFKC", value)
    if kind == "email":
        v = re.sub(r"\s*[\[({<]at[\])}>]\s*|\s+(?:at|arroba)\s+", "@", v, flags=re.I)
        v = re.sub(r"\s*[\[({<]dot[\])}>]\s*|\s+(?:dot|punto)\s+", ".", v, flags=re.I)
        return v.lower()
    if kind in PERMUTED:
        return re.sub(r"[^0-9A-Za-z+]", "", v).upper()
    if kind == "name":
        if "," in v:
            family, given = (x.strip() for x in v.split(",", 1))
            v = f"{given} {family}"
        v = re.sub(r"\s+[A-Z]\.", "", v)
    return " ".join(v.casefold().split())


# Country codes; a phone number keeps its own and its trunk zero.
COUNTRY = re.compile(r"\+(?:1|7|20|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{2})")


def _permute(secret: bytes, kind: str, value: str) -> str:
    """A keyed permutation of all values of one format: an alternating Feistel network over its digits and letters. Country codes and
    leading zeros belong to the format."""
    code_end = m.end() if kind == "phone" and (m := COUNTRY.match(value)) else 0
    at = [i for i, c in enumerate(value) if c.isascii() and c.isalnum() and i >= code_end]
    if kind == "phone" and at and value[at[0]] == "0":
        code_end, at = at[0] + 1, at[1:]
    radix = [10 if value[i].isdigit() else 26 for i in at]
    code = [ord(value[i]) - (48 if value[i].isdigit() else 97 if value[i].islower() else 65) for i in at]
    half = len(code) // 2
    form = re.sub(r"\W", "", value[:code_end]) + "|" + "".join("9" if r == 10 else "A" for r in radix)
    for turn in range(8):
        source, target = (range(half), range(half, len(code))) if turn % 2 == 0 else (range(half, len(code)), range(half))
        key = _digest(secret, f"{kind}|{form}|{turn}", ",".join(str(code[i]) for i in source))
        for i in target:
            key, shift = divmod(key, radix[i])
            code[i] = (code[i] + shift) % radix[i]
    out = list(value)
    for i, c, r in zip(at, code, radix):
        out[i] = chr(c + (48 if r == 10 else 97 if value[i].islower() else 65))
    return "".join(out)


class _Draw:
    """Choices that a number makes one after another."""

    def __init__(self, n: int) -> None:
        self.n = n

    def below(self, k: int) -> int:
        self.n, x = divmod(self.n, k)
        return x

    def of(self, letters, without: str = "") -> str:
        pool = [x for x in letters if x not in without] if without else letters
        return pool[self.below(len(pool))]

    def word(self, parts: int, syllables: list[str] = LATIN_SYLLABLES) -> str:
        return "".join(self.of(syllables) for _ in range(parts))

    def shifted(self, run: str) -> str:
        """Every digit and letter becomes another one; a first digit never a zero."""
        out = []
        for i, c in enumerate(run):
            if c.isdigit():
                pool = [d for d in "0123456789" if d != c and (i or d != "0")]
            else:
                pool = [x for x in ("abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if x != c]
            out.append(self.of(pool))
        return "".join(out)


def _like(word: str, example: str) -> str:
    return word.upper() if example.isupper() and len(example) > 1 else word.capitalize() if example[:1].isupper() else word


def _name(draw: _Draw, value: str, width: int) -> str:
    """An invented name in the script and order of ``value``; ``width`` more syllables than usual."""
    if re.search(r"[가-힣]", value):
        return draw.of(HANGUL_FAMILY, value) + "".join(draw.of(HANGUL_GIVEN, value) for _ in range(max(1, len(value.replace(" ", "")) - 1) + width))
    if re.search(r"[ぁ-ゖァ-ヺ]", value):
        raised = bool(re.search(r"[ァ-ヺ]", value))
        letters = [chr(ord(c) + 0x60) if raised else c for c in KANA_LETTERS]
        return "".join(c if c in " 　・" else draw.of(letters, value) for c in value) + "".join(draw.of(letters, value) for _ in range(width))
    if re.search(r"[一-鿿]", value):
        body = [c if c in " 　" else draw.of(HAN_GIVEN if i else HAN_FAMILY, value) for i, c in enumerate(value)]
        return "".join(body) + "".join(draw.of(HAN_GIVEN, value) for _ in range(width))
    syllables = CYRILLIC_SYLLABLES if re.search(r"[А-Яа-яЁё]", value) else LATIN_SYLLABLES
    first = normal("name", value).split(" ")[0]
    given, family = draw.word(3, syllables).capitalize(), draw.word(4 + width, syllables).capitalize()
    if syllables is LATIN_SYLLABLES:
        given = given[:-1] + draw.of(FEMALE_ENDING) if FEMALE.search(first) else given + draw.of("nrslm")
    middle = re.search(r"\s([A-Z])\.", value)
    shown = f" {draw.shifted(middle[1])}." if middle else ""
    return f"{family}, {given}" if "," in value else f"{given}{shown} {family}"


def _street(draw: _Draw, value: str, width: int) -> str:
    """An invented address of the form of ``value``: words that name a kind of place stay, all others and all numbers go."""
    more = [width]

    def new(m: re.Match) -> str:
        t = m[0]
        extra, more[0] = more[0], 0
        if m["n"]:
            more[0] = extra
            return draw.shifted(t)
        if m["ko"]:
            end = PLACE_ENDING_KO.search(t)
            if end and not end.start():
                more[0] = extra
                return t
            keep = end[0] if end else ""
            return "".join(draw.of(HANGUL_GIVEN, value) for _ in range(max(2, len(t) - len(keep)) + extra)) + keep
        if m["han"]:
            out, at = [], 0
            for part in [*PLACE_PART_HAN.finditer(t), None]:
                stem = t[at : part.start() if part else len(t)]
                out.append("".join(draw.of(HAN_GIVEN, value) for _ in range(len(stem) + (extra if stem else 0))))
                extra = 0 if stem else extra
                if part:
                    out.append(part[0])
                    at = part.end()
            more[0] = extra
            return "".join(out)
        if m["kana"]:
            return "".join(draw.of([chr(ord(c) + 0x60) for c in KANA_LETTERS], value) for _ in range(len(t) + extra))
        if t.lower() in PLACE_WORDS:
            more[0] = extra
            return t
        if len(t) <= 2 and t.isascii():
            more[0] = extra
            return draw.shifted(t)
        end = PLACE_ENDING_DE.search(t)
        keep = end[0] if end and end.start() > 2 else ""
        syllables = CYRILLIC_SYLLABLES if m["cy"] else LATIN_SYLLABLES
        return _like(draw.word(max(2, (len(t) - len(keep)) // 2) + extra, syllables), t) + keep

    return ADDRESS_TOKEN.sub(new, value)


def parts(value: str) -> set[str]:
    """Words and numbers of a value that tell something about it."""
    out = set()
    for t in re.findall(r"\d+|[^\W\d_]+", unicodedata.normalize("NFKC", value).lower()):
        t = PLACE_PART_HAN.sub("", PLACE_ENDING_DE.sub("", t) if len(t) > 6 else t)
        if t and t not in PLACE_WORDS and (len(t) > 1 or t.isdigit()):
            out.add(t)
    return out


def surrogate(secret: bytes, kind: str, value: str, salt: int = 0, width: int = 0) -> str:
    """A replacement of the same type, script, format and (for given names) gender reading that shares no word or number with ``value``.

    ``salt`` counts the entity's values that are taken already. Of a value that does share something the next one is tried, under the
    same salt, so that each salt gives one value.
    """
    if kind in PERMUTED:
        return _permute(secret, kind, value)
    value = unicodedata.normalize("NFKC", value)
    who = normal(kind, value)
    own = parts(value)
    for attempt in range(64):
        draw = _Draw(_digest(secret, f"{kind}|{attempt}", who, salt) << 256 | _digest(secret, f"{kind}|{attempt}|more", who, salt))
        if kind == "email":
            new = f"{draw.word(5 + width)}@{draw.word(4)}.invalid"
        else:
            new = (_street if kind == "street_address" else _name)(draw, value, width)
        if not own & parts(new):
            break
    return new


def exceptions(mentions: DataFrame, secret: str) -> tuple[int, dict[tuple[str, str], int]]:
    """(width, salts) of the ``mentions`` (kind, entity) of a corpus: how many syllables more than usual the corpus needs, and the entities whose first value is another one's.

    Distinct entities and the values they would get are counted in the cluster; only those that meet, at most ``MOST_EXCEPTIONS`` and a
    twentieth of all, come to the driver. More of them mean that the space is too small for the corpus: names grow by a syllable.
    """
    key = secret.encode()

    def values(kinds, entities_, salts, width):
        new = [normal(k, surrogate(key, k, v, n, width)) for k, v, n in zip(kinds, entities_, salts)]
        return {"kind": kinds, "entity": entities_, "salt": salts, "value": new}

    schema = "kind string, entity string, salt int, value string"
    drawn = F.col("kind").isin(*(k for k in KINDS if k not in PERMUTED))
    distinct = materialize(mentions.where(drawn).select("kind", "entity").distinct(), "entities")
    most = min(MOST_EXCEPTIONS, distinct.count() // 20 + 20)
    width = 0
    while True:
        salts: dict[tuple[str, str], int] = {}
        while True:
            known = dict(salts)
            valued = materialize(map_columns(distinct, ["kind", "entity"], lambda k, e: values(k, e, [known.get(x, 0) for x in zip(k, e)], width), schema), "values")
            first = valued.groupBy("kind", "value").agg(F.min("entity").alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
            late = valued.join(first, ["kind", "value"]).where("entity <> owner").select("kind", "entity", "salt")
            met = late.limit(most + 1).collect()
            if not met:
                return width, salts
            if len(met) + len(salts) > most:
                width += 1
                break
            salts |= {(r.kind, r.entity): r.salt + 1 for r in met}


def replace(text: str | None, secret: bytes, mode: str = "placeholder", width: int = 0, salts: dict[tuple[str, str], int] | None = None, found: list[Entity] | None = None) -> str | None:
    """The text with its entities replaced. With the ``width`` and ``salts`` of ``exceptions`` different originals of a corpus never
    share a surrogate, and mentions of the same one do; without them this holds within the text. ``found`` are its entities where they
    are known."""
    if not text:
        return text
    taken = dict(salts or {})
    owner: dict[tuple[str, str], str] = {}
    out, at = [], 0
    for e in entities(text) if found is None else found:
        value = text[e.start : e.end]
        who = normal(e.kind, value)
        if mode == "placeholder":
            new = f"[{e.kind.upper()}:{_digest(secret, e.kind, who) >> 176:020x}]"
        else:
            while True:
                new = surrogate(secret, e.kind, value, taken.get((e.kind, who), 0), width)
                if e.kind in PERMUTED or salts is not None or owner.setdefault((e.kind, normal(e.kind, new)), who) == who:
                    break
                taken[e.kind, who] = taken.get((e.kind, who), 0) + 1
        out += [text[at : e.start], new]
        at = e.end
    out.append(text[at:])
    return "".join(out)


def find(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kind, start, end, entity): every mention; map-only."""

    def batch(ids, texts):
        out = {"id": [], "kind": [], "start": [], "end": [], "entity": []}
        for i, t in zip(ids, texts):
            for e in entities(t):
                for name, v in zip(out, (i, e.kind, e.start, e.end, normal(e.kind, t[e.start : e.end]))):
                    out[name].append(v)
        return out

    return map_columns(documents.where(F.col(text_col).isNotNull()), [id_col, text_col], batch, "id bigint, kind string, start int, end int, entity string")


MARKED = "id bigint, text string, mentions array<struct<start:int,end:int,kind:string,entity:string>>"


def marked(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, mentions) of every row; map-only."""

    def batch(ids, texts):
        found = [[{"start": e.start, "end": e.end, "kind": e.kind, "entity": normal(e.kind, t[e.start : e.end])} for e in entities(t)] for t in texts]
        return {"id": ids, "text": texts, "mentions": found}

    return map_columns(documents, [id_col, text_col], batch, MARKED)


def replaced(documents: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text", mode: str = "placeholder") -> DataFrame:
    """(id, text) of every row with its entities replaced under the key ``secret``; texts never move. For surrogates the texts are written
    with their mentions first, so that they are searched once."""
    key = secret.encode()
    if mode == "placeholder":
        return map_columns(documents, [id_col, text_col], lambda ids, texts: {"id": ids, "text": [replace(t, key) for t in texts]}, "id bigint, text string")
    rows = materialize(marked(documents, id_col, text_col), "marked")
    width, salts = exceptions(rows.select(F.inline("mentions")), secret)
    shared = documents.sparkSession.sparkContext.broadcast(salts)  # at most ``MOST_EXCEPTIONS``

    def batch(ids, texts, mentions):
        known = [[Entity(m["start"], m["end"], m["kind"]) for m in ms] for ms in mentions]
        return {"id": ids, "text": [replace(t, key, mode, width, shared.value, found) for t, found in zip(texts, known)]}

    return map_columns(rows, ["id", "text", "mentions"], batch, "id bigint, text string")


def collisions(documents: DataFrame, secret: str) -> DataFrame:
    """(kind, surrogate, n): surrogates that different originals of the corpus share, an aggregate over distinct entities: empty, as
    numbers are permuted and all others are checked."""
    key = secret.encode()
    distinct = materialize(find(documents).select("kind", "entity").distinct(), "mentioned")
    width, salts = exceptions(distinct, secret)
    shared = documents.sparkSession.sparkContext.broadcast(salts)

    def batch(kinds, values):
        return {"kind": kinds, "surrogate": [normal(k, surrogate(key, k, v, shared.value.get((k, v), 0), width)) for k, v in zip(kinds, values)]}

    return map_columns(distinct, ["kind", "entity"], batch, "kind string, surrogate string").groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where("n > 1")


def p10_found(documents: DataFrame) -> DataFrame:
    def batch(ids, texts):
        out = {"doc_id": [], "kind": []}
        for i, t in zip(ids, texts):
            for kind in sorted({e.kind for e in entities(t)}):
                out["doc_id"].append(i)
                out["kind"].append(kind)
        return out

    return map_columns(documents.where(F.col("text").isNotNull()), ["doc_id", "text"], batch, "doc_id bigint, kind string")
