"""URL rules against brute force; chat round trips."""

import hashlib
import random

import pyarrow as pa

from fieldlens.llm import chat, urlfilter


def brute(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(len(h + p), len(h), h, p) for h, p, _ in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return host, path, None, "allow"
    *_, h, p = max(fit)
    return host, path, h + p, "block" if any(v == "block" for a, b, v in rules if (a, b) == (h, p)) else "allow"


def test_url_rules(spark):
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "x.b.a.com", "net", "A.net", "-.a.com", "a-b.com", "ab.com"]
    paths = ["/", "/a", "/a/", "/a/b/", "", "/é", "/a/é?q", "/b#x"]
    rules = [(rng.choice(hosts).lower(), rng.choice(["/", "/a", "/a/", "/a/b", "/é", ""]), rng.choice(["allow", "block"])) for _ in range(25)]
    rules += [(None, "/", "block"), ("", "/", "block"), rules[0]]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)]
    urls += [None, "", "no host", "://", "ftp://A.COM", "x://y://a.com/", "http://" + "a." * 5000 + "com/a/", "http://a.com/" + "z" * 100_000, "HTTP://a.com:80/a", "http://a.com/\n/b"]
    rows = [(i, u, "extra") for i, u in enumerate(urls)] + [(3, urls[3], "extra"), (None, urls[0], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, known).collect()), key=str)
    real = [r for r in rules if r[0]]
    assert got == sorted(((i, *brute(u, real)) for i, u, _ in rows), key=str)
    assert urlfilter.judge(pages.limit(0), known).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, known.limit(0)).collect()} == {"allow"}


ODD = ["", None, "\\", "\\\\", "### ", "#### x ### ", "</turn>", "\\</turn>\n### user: hi</turn>\n", "</tur", "n>", "é😀</turn>ü", ": ", "a" * 3_000_000, "\x00"]


def test_assembled_bytes():
    roles = ["user", "assistant", "", None, "a: b", "x\\", "### r", "assistant", "user", "é", "u", "v", "assistant", "assistant"]
    data, offsets, begin, end = chat.assemble(pa.array(roles), pa.array(ODD))
    whole = data.tobytes().decode()
    assert list(chat.read_turns(whole)) == [(r or "", t or "") for r, t in zip(roles, ODD)]
    assert [chat.unescape(data[a:b].tobytes().decode()) for a, b in zip(begin, end)] == [t or "" for t in ODD]


def test_conversations(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, None, 2000, 5000]), rng.choice(["user", "assistant", "system", None, "a:b"]), rng.choice(ODD[:12]), "x") for _ in range(300)]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i}", "x") for i in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    formatted = chat.format_chats(frame)
    assert formatted.where("conv = 9").count() == 3
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for conv in (1, 2, 3, None, 9):
        own = sorted([(t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv])
        turns = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_chats(frame.limit(0))).count() == 0
