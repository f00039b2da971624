import random
import re

import pytest

from streetloom.functions import content


@pytest.mark.parametrize(
    "header, media, charset",
    [
        ("text/html; charset=UTF-8", "text/html", "utf-8"),
        ("TEXT/HTML", "TEXT/HTML", None),
        (' text/html ;Charset="ISO-8859-1"; x=y', "text/html", "iso-8859-1"),
        ("text/html; charset=a; charset=b", "text/html", "b"),
        ("text/html;", "text/html", None),
        ('text/html; charset=""', "text/html", None),
        (None, None, None),
    ],
)
def test_content_type(one, header, media, charset):
    assert one(content.media_type, [header], "h string") == [media]
    assert one(content.charset, [header], "h string") == [charset]


BODIES = [
    ("aé€".encode(), None), (b"ok \xff end", "utf-8"), (b"cut \xe2\x82", "UTF8"), (b"\x80 euro", "windows-1252"),
    (b"caf\xe9", "latin-1"), (b"a\xe9b", "us-ascii"), ("日本".encode("shift_jis"), "shift_jis"),
    (b"x\xc3\xa9", "x-none"), (b"\xf0\x9f\x98\x80\xed\xa0\x80", "utf-8"), (b"hex", "hex"),
]


def test_decode_replaces_like_python(one):
    def python(raw, name):
        try:
            return raw.decode(name or "utf-8", errors="replace"), True
        except LookupError:
            return raw.decode("utf-8", errors="replace"), False

    got = one(lambda b, c: content.decode_body(b, c), BODIES, "b binary, c string")
    assert [(r["text"], r["known"]) for r in got] == [python(*row) for row in BODIES]


def test_decode_strict_drops_like_python(one):
    def python(raw, name):
        try:
            return raw.decode(name or "utf-8")
        except (LookupError, UnicodeDecodeError):
            return None

    got = one(lambda b, c: content.decode_body_strict(b, c), BODIES, "b binary, c string")
    assert got == [python(*row) for row in BODIES]


def test_sniffed_charset(one):
    rows = [b'<meta charset="UTF-8">', b"CHARSET= latin1;", b"charset='x", b"none", b"\xff charset=a_b-1\xe9"]
    assert one(content.sniff_charset, rows, "b binary") == ["utf-8", "latin1", "x", None, "a_b-1"]


def test_address_window_is_byte_exact(one):
    rng = random.Random(5)
    rows = []
    for _ in range(40):
        filler = [bytes(rng.randrange(256) for _ in range(rng.randrange(4000))) for _ in range(3)]
        mark = rng.choice([b'"address"', b'"ADDress"'])
        rows.append(mark.join(filler[: rng.randrange(2, 4)]))

    def python(body):
        lowered = body.lower()
        start = max(lowered.find(b'"address"') - 1600, 0)
        return body[start : min(lowered.rfind(b'"address"') + 2400, len(body) - 1)]

    assert [bytes(b) for b in one(content.address_window, rows, "b binary")] == [python(b) for b in rows]
    assert all(re.search(rb'"address"', r.lower()) for r in rows)
