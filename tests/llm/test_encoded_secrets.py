"""Encoded secrets as they come in real texts: escaped, indented, quoted, wrapped once more, and OpenSSH keys."""

import base64
import json
import textwrap

import pytest
from test_text_models import HEADER, RSA

from tidemark.llm import secret_scan as ss


def field(data):
    return len(data).to_bytes(4, "big") + data


def lines(data, width=64, code=base64.b64encode):
    return textwrap.wrap(code(data).decode(), width)


def pem(body):
    return "-----BEGIN PRIVATE KEY-----\n" + "\n".join(body) + "\n-----END PRIVATE KEY-----\n"


KEY = lines(RSA)
OPENSSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + b"\0\0\0\1" + field(field(b"ssh-ed25519") + field(b"p" * 32)) + field(b"k" * 136)
TOKEN = f"{HEADER}.e30.c2ln"
FORMS = {
    "plain": ("key_der", pem(KEY)),
    "json": ("key_der", json.dumps({"type": "service_account", "private_key": pem(KEY)})),
    "json twice": ("key_der", json.dumps(json.dumps({"private_key": pem(KEY)}))),
    "yaml": ("key_der", "key: |\n" + textwrap.indent(pem(KEY), "    ")),
    "mail": ("key_der", textwrap.indent(pem(KEY), "> ")),
    "code": ("key_der", "k = " + " +\n    ".join(json.dumps(x + "\n") for x in KEY)),
    "after a word": ("key_der", "the key\n" + "\n".join(KEY)),
    "windows": ("key_der", pem(KEY).replace("\n", "\r\n")),
    "base64url": ("key_der", "k=" + base64.urlsafe_b64encode(RSA).decode()),
    "hex lines": ("key_hex", "\n  ".join(textwrap.wrap(RSA.hex(), 64))),
    "openssh": ("key_openssh", pem(lines(OPENSSH, 70))),
    "openssh json": ("key_openssh", json.dumps(pem(lines(OPENSSH, 70)))),
    "token in base64": ("signed_token", "t: " + base64.b64encode(TOKEN.encode()).decode()),
    "token in hex": ("signed_token", "t: " + TOKEN.encode().hex()),
    "pem in base64": ("key_der", "tls.key: " + base64.b64encode(pem(KEY).encode()).decode()),
}


@pytest.mark.parametrize("form", FORMS)
def test_forms(form):
    kind, text = FORMS[form]
    (start, k, end), = ss.confirmed_spans("é " + text + " end")
    assert ss.KINDS[k] == kind
    if form in ("json", "yaml", "mail", "code", "hex lines", "plain"):
        first, last = (KEY[0], KEY[-1]) if kind == "key_der" else (RSA.hex()[:64], RSA.hex()[-2:])
        found = ("é " + text + " end")[start:end]
        assert found.startswith(first) and found.endswith(last)


def test_what_only_looks_like_a_secret():
    cut = OPENSSH[:-1]
    for text in (pem(lines(RSA[:-1])), pem(lines(cut)), base64.b64encode(b"eyJub3QiOiJqc29u.e30.x").decode(), RSA.hex()[:-2], base64.b64encode(b"-----BEGIN NOTHING-----").decode(), "Microsoft Mountain\nMIIEpAIBAAKCAQEA\nMississippi"):
        assert ss.confirmed_spans(text) == []


def test_two_tokens_in_two_lines():
    wrapped = base64.b64encode(TOKEN.encode()).decode().rstrip("=")
    assert [k for _, k, _ in ss.confirmed_spans(f"{wrapped}\n{wrapped}\n")] == [5, 5]


@pytest.mark.parametrize("code", [lambda d: base64.b64encode(d).decode(), bytes.hex])
@pytest.mark.parametrize("more", [1, 2, 60, 61])
def test_a_span_ends_with_the_key(code, more):
    alone, text = code(RSA).rstrip("="), "k " + code(RSA + b"\xff" * more)
    (start, k, end), = ss.confirmed_spans(text)
    assert ss.KINDS[k] in ("key_der", "key_hex") and start == 2 and end - start == len(alone)


def test_a_key_inside_a_run_is_found_at_its_own_digits():
    body = base64.urlsafe_b64encode(RSA).decode().rstrip("=")
    for before in ("", "A-", "AB_", "ABC-", "ABCD-"):
        text = f"x {before}{body}-tail"
        assert [(ss.KINDS[k], text[s:e]) for s, k, e in ss.confirmed_spans(text)] == [("key_der", body)]


@pytest.mark.parametrize("line", ["MIIEpAIBAAKCAQEA" + "A" * 48, "MIL/AIBAAIAAgACAAIAAgAC" + "AgACAAIA" * 5, "-ZXlK" * 12, "_LS0tLS1CRUdJTi" * 4, "b3BlbnNzaC1rZXktdjEAAAAABG5vbmU" + "A" * 33, "3082ffff0201000282010100" + "00" * 20])
def test_hostile_texts_take_linear_time(line):
    import time

    text = (line + "\n") * (5_000_000 // len(line))
    began = time.perf_counter()
    ss.confirmed_spans(text)
    assert time.perf_counter() - began < 30
