import re
import unicodedata

import pytest

from corpusmill.llm import personal as P

KEY = b"secret"


def found(text):
    return [(e.kind, text[e.start : e.end]) for e in P.entities(text)]


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("contact: m_quillfeather+dev@northloop.invalid now", "email", "m_quillfeather+dev@northloop.invalid"), ("Logs to nikolai10 [at] posthaus [dot] invalid.", "email", "nikolai10 [at] posthaus [dot] invalid"),
        ("문의는 zelda29 AT northloop DOT invalid 로", "email", "zelda29 AT northloop DOT invalid"), ("(reach me at y_y(at)tealbox.example)", "email", "y_y(at)tealbox.example"),
        ("Call me on +17465550188 before noon.", "phone", "+17465550188"), ("tel: 020 7946 0276", "phone", "020 7946 0276"), ("My number is (974) 555-0175.", "phone", "(974) 555-0175"), ("On-call phone 362.555.0146 rings", "phone", "362.555.0146"),
        ("Joignable au +33 1 99 00 47 79.", "phone", "+33 1 99 00 47 79"), ("Telefonisch unter 030 / 23125 266 erreichbar.", "phone", "030 / 23125 266"), ("전화는 010-0000-6297 입니다.", "phone", "010-0000-6297"), ("Phone=+44 7700 900928;ext=4", "phone", "+44 7700 900928;ext=4"),
        ("row 4 has SSN 666 34-7888, drop it", "identity_number", "666 34-7888"), ("주민번호 621114-1510882 값이", "identity_number", "621114-1510882"), ("my NI number is QV 40 71 63 Z", "identity_number", "QV 40 71 63 Z"), ("mi DNI es 42451876C en", "identity_number", "42451876C"),
        ("my passport no. is ZQ0492236", "identity_number", "ZQ0492236"),
        ("I live at 66B Nine Elms Vale Avenue, Apt 29, Galloford Q6 7ZZ.", "street_address", "66B Nine Elms Vale Avenue, Apt 29, Galloford Q6 7ZZ"), ("Die Anschrift lautet Rabensteinstr. 40b, 06910 Musterheim.", "street_address", "Rabensteinstr. 40b, 06910 Musterheim"),
        ("L'adresse est 197 bis, avenue du Vieux-Four, 00886 Valmontel.", "street_address", "197 bis, avenue du Vieux-Four, 00886 Valmontel"), ("La dirección es Calle del Molino Viejo, 176, 2º D, Villarqueda.", "street_address", "Calle del Molino Viejo, 176, 2º D, Villarqueda"),
        ("주소는 가온시 나래구 가람길 95길 17 입니다.", "street_address", "가온시 나래구 가람길 95길 17"),
        ("As Jarek Valcourteau pointed out, yes", "name", "Jarek Valcourteau"), ("Danke an Farrowdale, Yorick für den Hinweis", "name", "Farrowdale, Yorick"), ("Hi Prof. Joram Stroudahl,", "name", "Joram Stroudahl"), ("| Ms Viveka Quennevil | 12 |", "name", "Viveka Quennevil"),
        ('{"assignee": "Quilla Zellweg"}', "name", "Quilla Zellweg"), ("제갈나래 님이 먼저 알려 주셨습니다.", "name", "제갈나래"), ("담당자는 서문자람입니다.", "name", "서문자람"), ("Reported by Nikolai A. Vandermoor during", "name", "Nikolai A. Vandermoor"),
    ],
)
def test_found(text, kind, value):
    assert found(text) == [(kind, value)]
    out = P.replace(text, KEY)
    a = text.index(value)
    assert out.startswith(text[:a] + f"[{kind.upper()}:") and out.endswith(text[a + len(value) :])


@pytest.mark.parametrize(
    "text",
    [
        "Clone it from git@code.depot.example:team/x.git first.", "ssh runner@192.0.2.37 and restart it.", "Pinned to quillnet@38.6.38 for now.", "It computes `left@right.mean()` for 26 tiles.", 'Use `@app.route("/x")` above.',
        "Catalogue number 978-0-3477-23-5.", "Timestamp 1541554150 seconds.", "Ticket 240127-26 was closed.", "Build 202427-5845 finished in 1 s.", "Version 16.2.16.4897 broke it.", "Ports 2943-2943 are open on 192.0.2.1.",
        "Street View tiles 3384 to 33849 are missing.", "Lane Detection and Road Segmentation use 18 layers.", "Move card 29 to the Fast Lane column.", "We use Random Forest and Monte Carlo runs in Visual Studio.", "Docker Compose and Apache Beam are both fine.",
        "Every entry of the Job Queue wrote nothing.", "서로 닿은 두 개를 바꾼다, 손님이 691명씩 떠난다.", "See issue #7891 and commit ac02011.", "etwa 775 Sekunden.\n\nLane Detection",
    ],
)
def test_not_personal(text):
    assert found(text) == [] and P.replace(text, KEY) == text


def test_same_person_same_placeholder():
    out = P.replace("cc Ilka Grimsholt\nThanks to Grimsholt, Ilka for it\ncc Ilka Zellweg", KEY)
    marks = [x.split("]")[0] for x in out.split("[")[1:]]
    assert len(marks) == 3 and marks[0] == marks[1] != marks[2]


@pytest.mark.parametrize("value", ["+44 7700 900928", "(974) 555-0175", "QV 40 71 63 Z", "010-0000-6297"])
def test_number_surrogates_keep_their_format_and_never_collide(value):
    form = lambda s: "".join("9" if c.isdigit() else "A" if c.isalpha() else c for c in s)
    new = P.surrogate(KEY, "phone", value)
    assert form(new) == form(value) and new != value and new == P.surrogate(KEY, "phone", value) != P.surrogate(b"other", "phone", value)
    many = {P.surrogate(KEY, "phone", f"010-0000-{i:04d}") for i in range(10_000)}
    assert len(many) == 10_000


def test_surrogates_keep_script_and_order():
    assert P.surrogate(KEY, "name", "제갈나래").isalpha() and "가" <= P.surrogate(KEY, "name", "제갈나래")[0] <= "힣"
    assert ", " in P.surrogate(KEY, "name", "Zellweg, Ilka") and P.surrogate(KEY, "email", "a@b.example").endswith(".invalid")
    text = "cc Ilka Grimsholt, mail i@x.example or j@x.example, i@x.example"
    out = P.replace(text, KEY, "surrogate")
    mails = [w.rstrip(",") for w in out.split() if "@" in w]
    assert mails[0] == mails[2] != mails[1] and "Ilka" not in out


ADDRESSES = (
    "12 Baker Street, London", "7 Old Mill Lane\nFlat 3, Leeds LS1 4AB", "Hauptstraße 12a, 10115 Berlin", "Unter den Linden 5", "12 bis, rue de la Paix, 75002 Paris", "Calle de Alcalá 42, 28014 Madrid", "서울특별시 강남구 테헤란로 12길 5 2층", "경기도 성남시 분당로 77",
    "北京市朝阳区建国路88号", "東京都新宿区西新宿2丁目8番1号", "上海市南京路100号3室",
)


@pytest.mark.parametrize("value", ADDRESSES)
def test_address_surrogates_share_nothing(value):
    new = P.surrogate(KEY, "street_address", value)
    assert not P.parts(value) & P.parts(new) and not set(re.findall(r"\d+", value)) & set(re.findall(r"\d+", new))
    script = lambda s: ["9" if c.isdigit() else "가" if "가" <= c <= "힣" else "一" if "一" <= c <= "鿿" else "a" if c.isalpha() else c for c in re.sub(r"\w+", lambda m: m[0][:1], s)]
    assert script(new) == script(value)
    stays = [w for w in ("Street", "Lane", "straße", "rue de la", "Calle de", "특별시", "로", "市", "区", "路", "号", "丁目") if w in value]
    assert all(w in new for w in stays) and new != P.surrogate(b"other", "street_address", value)
    assert P.normal("street_address", new) == P.normal("street_address", P.surrogate(KEY, "street_address", P.normal("street_address", value)))


@pytest.mark.parametrize("value", ["王小明", "山田 太郎", "やまだ たろう", "タナカ", "Иван Петров", "김철수", "Ilka Grimsholt", "Anna-Lena van Dyck", "Zoë O'Neill"])
def test_name_surrogates_keep_their_script(value):
    new = P.surrogate(KEY, "name", value)
    kind = lambda s: {unicodedata.name(c).split(" ")[0] for c in s if c.isalpha()}
    assert kind(new) == kind(value) and not P.parts(value) & P.parts(new) and new.count(" ") <= value.count(" ")
    assert len(kind(value) & {"CJK", "HANGUL", "HIRAGANA", "KATAKANA"}) == 0 or not set(value) & set(new) - {" "}


def test_country_codes_stay():
    assert P.surrogate(KEY, "phone", "+1 212-555-0175").startswith("+1 ") and P.surrogate(KEY, "phone", "+44 7700 900928").startswith("+44 ")
    assert P.surrogate(KEY, "phone", "010-0000-6297").startswith("0") and re.sub(r"\D", "", P.surrogate(KEY, "phone", "(974) 555-0175")) == re.sub(r"\D", "", P.surrogate(KEY, "phone", "974.555.0175"))


def test_no_two_people_of_a_corpus_share_a_surrogate(frame):
    """More Korean names than short surrogates can keep apart."""
    given = [a + b for a in P.HANGUL_GIVEN for b in P.HANGUL_GIVEN][:1400]
    df = frame([(i, f"담당자는 {f}{g}입니다") for i, (f, g) in enumerate((f, g) for f in "김이" for g in given)], "doc_id long, text string")
    names = [r.text for r in P.replaced(df, "k", mode="surrogate").collect()]
    assert P.find(df).select("entity").distinct().count() == len(set(names)) > 2000 and P.collisions(df, "k").count() == 0


def test_frames(frame):
    df = frame([(1, None, "x"), (2, "", "x"), (3, "cc Ilka Grimsholt, a@b.example a@c.example", "x"), (3, "cc Ilka Grimsholt", "x"), (4, "y" * 200_000, "x")], "doc_id long, text string, kind string")
    assert sorted(tuple(r) for r in P.p10_found(df).collect()) == [(3, "email"), (3, "name"), (3, "name")]
    assert P.replaced(df, "k").count() == 5 and P.replaced(df, "k").where("text IS NULL").count() == 1
    assert P.collisions(df, "k").count() == 0 and P.p10_found(df.limit(0)).count() == 0
