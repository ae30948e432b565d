import base64
import bz2
import gzip
import hashlib
import re
import urllib.parse
import zlib

from quillspark.llm import secrets as S

HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
KEY = "AKIA" + "Q" * 16


def brute(text):
    """The patterns as they are written down, all matches, those that are too short dropped."""
    found = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


TEXTS = [
    "", "plain words", f'token = "{HEX}" x', "Password: hunter22 passwd=short", f"{KEY} AKIA123", "token:token:abcdefgh secret=token=abcdef", "API_KEY='a.b-c=d/e+f'", "ſecret=abcdefgh toKen=abcdefgh",
    "é" * 5 + f"apikey={HEX}" + "日本", "AKIAAKIA" + "B" * 20, "token =\nabcdefgh", f"password{' ' * 5}={' ' * 3}secret99",
]


def test_base_spans_follow_the_patterns():
    for t in TEXTS:
        assert S.base_spans(t) == brute(t), t


def spans(text):
    return S.shown(S.all_spans(text)).split(",")


def test_layers_are_unwrapped_and_mapped_to_the_original():
    secret = "password=hunter2222"
    for prefix in ("", "é日 before "):
        quoted = "".join(f"%{b:02X}" for b in secret.encode())
        assert f"assign:{len(prefix)}:{len(prefix) + len(quoted)}" in spans(prefix + quoted)
        escaped = "".join(f"\\u{ord(c):04x}" for c in secret)
        assert f"assign:{len(prefix)}:{len(prefix) + len(escaped)}" in spans(prefix + escaped)
        for data in (gzip.compress(secret.encode()), zlib.compress(secret.encode()), gzip.compress(zlib.compress(secret.encode()))):
            b = base64.b64encode(data).decode()
            assert f"assign:{len(prefix)}:{len(prefix) + len(b)}" in spans(f"{prefix}{b} after")
        twice = urllib.parse.quote(base64.b64encode(base64.b64encode(secret.encode())).decode())
        assert f"assign:{len(prefix)}:{len(prefix) + len(twice)}" in spans(f"{prefix}{twice}") or any(x.startswith("assign") for x in spans(f"{prefix}{twice}"))


def test_base64_spans_map_to_their_characters():
    inner = "xx " + KEY + " yy"
    b = base64.b64encode(inner.encode()).decode()
    a, e = 3 * 8 // 6, ((3 + len(KEY)) * 8 - 1) // 6 + 1
    assert f"access:{2 + a}:{2 + e}" in spans("> " + b)


def test_decoding_ends():
    cycle = "%25" * 50 + "25" * 10
    assert S.all_spans(cycle) == S.base_spans(cycle)
    deep = "token=abcdefgh"
    for _ in range(12):
        deep = base64.b64encode(deep.encode()).decode()
    assert any(k == 0 for _, k, _ in S.all_spans(deep))
    bomb = base64.b64encode(zlib.compress(b"zebra " * 2_000_000)).decode()
    assert S.all_spans(bomb) == S.base_spans(bomb)


def test_base_spans_stay():
    for t in TEXTS:
        assert set(S.base_spans(t)) <= set(S.all_spans(t))


def test_scan_rows(spark, docs_of):
    rows = [*enumerate(TEXTS), (99, None), (99, None), (None, TEXTS[2])]
    out = S.scan_secrets(docs_of(rows)).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    for i, t in enumerate(TEXTS):
        want = brute(t)
        assert by[i]["base_sha256"] == hashlib.sha256(S.shown(want).encode()).hexdigest()
        assert [by[i][f"n_{k}"] for k in S.KINDS] == [sum(x[1] == k for x in want) for k in range(3)]
    assert by[99]["spans"] == "" and by[99]["n_hex"] == 0
    assert S.scan_secrets(docs_of([])).count() == 0


def test_redaction_keeps_schema_and_leaves_nothing(spark, docs_of):
    d = docs_of([(0, TEXTS[2]), (1, "clean"), (2, None), (3, base64.b64encode(b"password=hunter2222").decode())]).withColumnRenamed("lang", "spans")
    out = S.redact_secrets(d)
    assert out.schema == d.schema
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == "clean" and rows[2]["text"] is None
    for i in (0, 3):
        assert S.all_spans(rows[i]["text"]) == [] and "[REDACTED]" in rows[i]["text"] and rows[i]["n_chars"] == len(rows[i]["text"])


def packed(text):
    return base64.b64encode(gzip.compress(text.encode())).decode()


def test_long_streams_are_scanned_in_pieces():
    """Streams of more than 32 MB hide nothing, whether they have line ends or not, nor what is packed in them."""
    fill, wide = "zebra, " * 3_000_000, "zebra\n" * 2_000_000
    inner = packed(f"{wide}token=abcdefgh")
    for text, kinds in ((f"{fill}{KEY}{fill}", {1}), (f"{fill}{HEX}{fill}{inner} {fill}", {0, 2}), ("zebra " * 7_000_000 + KEY, {1})):
        assert len(text) > 32 << 20
        b = packed(text)
        assert S.all_spans(f"{b} after") == [(0, k, len(b)) for k in sorted(kinds)]
    assert S.redacted(f"{b} after") == "[REDACTED] after"
    b = base64.b64encode(gzip.compress(fill.encode() * 2 + b"\0" + KEY.encode())).decode()
    assert S.all_spans(b) == [(0, 1, len(b))]


def test_pieces_cut_no_pattern(monkeypatch):
    """Wherever pieces end, they hold what the whole text holds."""
    monkeypatch.setattr(S, "CHUNK", 5)
    monkeypatch.setattr(S, "PIECE", 7)
    quoted = "".join(f"%{b:02X}" for b in b"password : hunter22")
    for secret, kind in ((KEY, 1), (HEX, 2), ("secret  =  'abcdefgh'", 0), (quoted, 0), ("p%61ssword  %3A abcdefgh", 0), (base64.b64encode(b"passwd: hunter2222").decode(), 0), (packed("passwd: hunter2222"), 0)):
        for k in range(12):
            text = f"{'x' * k}, some plain words here {secret} and more of them, é"
            data = gzip.compress(text.encode())
            assert "".join(S._pieces(data, 1)) == text
            b = base64.b64encode(data).decode()
            assert [x[1] for x in S.all_spans(b) if x[::2] == (0, len(b))] == [kind], (k, secret)


def test_wrapped_and_glued_runs():
    """A run wrapped at line ends is put together, and one that follows a path or a hyphenated word is found."""
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(60)) + f" {KEY} " + " ".join(f"more{i * 31}" for i in range(40))
    for end in ("\n", "\r\n"):
        for data, kinds in ((gzip.compress(text.encode()), [1]), (text.encode(), [1])):
            b = base64.b64encode(data).decode()
            lines = end.join(b[i : i + 76] for i in range(0, len(b), 76))
            for before, after in (("see: ", " end"), ("aLongerWordThanSixteen\n", "\nand other words")):
                got = S.all_spans(before + lines + after)
                assert [k for _, k, _ in got] == kinds and all(len(before) <= s < e <= len(before) + len(lines) for s, _, e in got)
    straddling = "x" * 50 + " token=abcdefgh " + "y" * 50
    b = base64.b64encode(straddling.encode()).decode()
    (a, _, e), = S.all_spans(f"{b[:76]}\n{b[76:]}")
    assert a == 51 * 8 // 6 and e == (65 * 8 - 1) // 6 + 2
    for glue in ("some/path/", "a-b-word-", "x_", "data/x-yz_"):
        for data in (b"password=hunter2222", gzip.compress(b"password=hunter2222")):
            b = base64.b64encode(data).decode().rstrip("=")
            (s, k, e), = S.all_spans(f"{glue}{b}")
            assert (s, k, e) == (len(glue), 0, len(glue) + len(b)), glue


def deflated(data):
    z = zlib.compressobj(wbits=-15)
    return z.compress(data) + z.flush()


def test_members_raw_streams_and_bytes_that_are_no_text():
    line = b"password=hunter2222 and some more words"
    whole = {
        "second member": gzip.compress(b"nothing in here") + gzip.compress(line),
        "raw deflate": deflated(line * 3),
        "raw in gzip": gzip.compress(zlib.compress(line)),
    }
    for name, data in whole.items():
        b = base64.b64encode(data).decode()
        assert [(s, k) for s, k, _ in S.all_spans(f"see {b} end")] == [(4, 0)], name
    for name, data in {"control": line + b"\x01", "Latin-1": "é ".encode("latin-1") + line, "UTF-16": line.decode().encode("utf-16-le"), "big": line.decode().encode("utf-16"), "random head": bytes(range(128, 158)) + line}.items():
        b = base64.b64encode(data).decode().rstrip("=")
        got = S.all_spans(f"see {b} end")
        assert [k for _, k, _ in got] == [0] and 4 <= got[0][0] < got[0][2] <= 4 + len(b), name
    for glue in ("a/", "abc/", "ab/", "x", "xy", "xyz"):
        b = base64.b64encode(line * 2).decode().rstrip("=")
        assert 0 in {k for _, k, _ in S.all_spans(glue + b)}, glue


def layers_of(text, depth=3):
    """Every text that a chain of decoders makes of a text, one by one and whole, without places."""
    if not depth:
        return {text}
    found = {text, urllib.parse.unquote(text), re.sub(r"\\u([0-9a-f]{4})", lambda m: chr(int(m[1], 16)), text)}
    for run in re.findall(r"[A-Za-z0-9+/]{16,}={0,2}", text):
        try:
            data = base64.b64decode(run.rstrip("=") + "=" * (-len(run.rstrip("=")) % 4))
        except ValueError:
            continue
        for f in (bytes, gzip.decompress, zlib.decompress):
            try:
                found.add(f(data).decode())
            except (ValueError, OSError, zlib.error, EOFError):
                pass
    return found.union(*(layers_of(x, depth - 1) for x in found - {text}))


def test_chains_against_a_plain_decoder():
    """Whatever chain of encoders hides a secret, its kinds are those that decoding everything shows."""
    import random

    r = random.Random(3)
    encoders = [
        lambda t: "".join(f"%{b:02X}" for b in t.encode()),
        lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
        lambda t: base64.b64encode(t.encode()).decode(),
        lambda t: base64.b64encode(gzip.compress(t.encode())).decode(),
        lambda t: base64.b64encode(zlib.compress(t.encode())).decode(),
    ]
    for _ in range(60):
        text = r.choice(["token=abcdefgh", KEY, "no secret in this one", "api_key: zzzzzzzz"])
        for _ in range(r.randint(1, 3)):
            text = f"{r.choice(['', 'x ', 'né '])}{r.choice(encoders)(text)}{r.choice(['', ' y'])}"
        want = {k for layer in layers_of(text) for _, k, _ in brute(layer)}
        assert {k for _, k, _ in S.all_spans(text)} == want, text


def test_very_long_texts_take_bounded_memory():
    import tracemalloc

    text = "a%41" * 500_000 + " token=abcdefgh"
    tracemalloc.start()
    got = S.all_spans(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[-1] == (len(text) - 14, 0, len(text)) and peak < 60 * len(text)


def test_raw_streams_whatever_they_begin_with():
    """What a raw stream begins with says nothing about what is in it."""
    secret = "token=abcdefgh"
    for name, data in {
        "no ASCII": deflated(("한국어 문장 " * 50 + secret).encode()),
        "marks": deflated(("é ü " * 300 + secret).encode()),
        "gzip in it": deflated(gzip.compress(f"some words {secret} more".encode())),
        "long": deflated(("é" * 40_000 + secret).encode()),
    }.items():
        b = base64.b64encode(data).decode()
        assert S.all_spans(f"see {b} end") == [(4, 0, 4 + len(b))], name
    noise = base64.b64encode(bytes(i * 7919 % 251 for i in range(3000))).decode()
    assert S.all_spans(noise) == S.base_spans(noise)


def test_streams_that_are_cut_off():
    import os

    text = ("words " * 200 + "token=abcdefgh " + os.urandom(300).hex(" ")).encode()
    for pack in (gzip.compress, zlib.compress):
        whole = pack(text)
        b = base64.b64encode(whole[:-12]).decode()
        assert 0 in {k for _, k, _ in S.all_spans(f"see {b} end")}


def test_bzip2_and_references():
    secret = b"password=hunter2222 and words"
    for data in (bz2.compress(secret), bz2.compress(secret) + bz2.compress(b"more"), gzip.compress(bz2.compress(secret)), bz2.compress(gzip.compress(secret))):
        b = base64.b64encode(data).decode()
        assert S.all_spans(f"see {b} end") == [(4, 0, 4 + len(b))]
    decimal = "".join(f"&#{ord(c)};" for c in "token=abcdefgh")
    mixed = "tok&#x65;n&#X3D;&quot;abcdefgh&quot;"
    for t in (decimal, mixed):
        assert S.all_spans(f"a {t} b")[0][:2] == (2, 0), t
    assert S.all_spans(f"a {decimal} b") == [(2, 0, 2 + len(decimal))]
    assert S.all_spans("&#0; &#x110000; &#xD800; &#9999999; &none; &amp") == []
    deep = "".join(f"&amp;#{ord(c)};" for c in "token=abcdefgh")
    assert S.all_spans(deep) == [(0, 0, len(deep))]
    assert S.redacted(f"x {mixed} y") == "x [REDACTED]&quot; y"


def test_runs_of_one_pattern_take_linear_time():
    import time

    took = []
    for n in (50_000, 200_000):
        began = time.process_time()
        assert S.all_spans("abc/" * n) == []
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.5
