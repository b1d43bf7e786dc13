"""Chat formatting and URL rules."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crowdtide.llm import chat
from crowdtide.llm.url_rules import RULE, judge_urls

PARTS = [*chat.CONTROLS, "\\", "\\!", "<", "|", ">", "[", "/", "!", "\n", "ok", "</s", "s>", "🙂"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)


@given(TEXT)
@settings(max_examples=500, deadline=None)
def test_escape_is_undone_and_leaves_no_control(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a|>\nb", ""]), TEXT), max_size=5))
@settings(max_examples=300, deadline=None)
def test_messages_are_read_back(messages):
    assert chat.read_back("".join(chat.render(*m)[0] for m in messages)) == messages
    for role, text in messages:
        formatted, a, b = chat.render(role, text)
        assert chat.unescape(formatted[a:b]) == (text if role == "assistant" else "")


def test_text_between_messages_is_an_error():
    with pytest.raises(ValueError):
        chat.read_back("x" + chat.render("user", "a")[0])


def log(spark, *events):
    return spark.createDataFrame(list(events), chat.EVENT)


def said(df):
    return [(r["conv_id"], r["turn"], *chat.read_back(r["formatted"])[0]) for r in sorted(df.collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["turn"]))]


def test_events_are_folded(spark):
    events = log(
        spark,
        (1, 1, 0, "open", "user", None), (1, 2, 0, "delta", None, "Hel"), (1, 3, 0, "delta", None, "lo"),
        (1, 4, 1, "open", "assistant", None), (1, 5, 1, "delta", None, "bad"), (1, 6, 1, "regenerate", None, None),
        (1, 7, 1, "delta", None, "good"), (1, 8, 2, "open", "user", None), (1, 9, 2, "delta", None, "more"),
        (2, 1, 0, "open", "user", None), (2, 2, 0, "delta", None, "first"), (2, 3, 1, "open", "assistant", None),
        (2, 4, 1, "delta", None, "answer"), (2, 5, 0, "edit", None, "second"), (2, 6, 1, "open", "assistant", None),
        (2, 7, 1, "delta", None, "new answer"),
    )
    want = [(1, 0, "user", "Hello"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (2, 0, "user", "second"), (2, 1, "assistant", "new answer")]
    assert said(chat.format_chats(events.repartition(5))) == want


def test_odd_events(spark):
    events = log(
        spark,
        (None, 1, 0, "open", None, None), (None, 2, 0, "delta", None, None), (3, 1, 0, "delta", "user", "no open"), (3, 2, 0, "ping", None, "x"),
        (4, 1, 0, "open", "user", None), (4, 2, 0, "delta", None, "x" * 100_000),
    )
    assert said(chat.format_chats(events)) == [(None, 0, "", ""), (3, 0, "user", "no open"), (4, 0, "user", "x" * 100_000)]
    assert chat.format_chats(log(spark)).collect() == []


def folded(events):
    """(conv_id, turn, role, text) of what a log says in the end, by brute force: event by event."""
    said = {}
    for conv, _, turn, kind, role, text in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        if kind in ("edit", "regenerate"):
            for key in [k for k in said if k[0] == conv and k[1] > turn]:
                del said[key]
        who, pieces = said.get((conv, turn), (None, []))
        who = role if role is not None else who
        pieces = {"open": pieces, "delta": [*pieces, text or ""], "edit": [text or ""], "regenerate": []}[kind]
        said[conv, turn] = who, pieces
    return [(*k, who or "", "".join(pieces)) for k, (who, pieces) in sorted(said.items())]


def test_random_logs_are_folded_as_event_by_event(spark):
    rng = random.Random(7)
    events = []
    for conv in range(60):
        turn, seq, begun = 0, 0, False
        for _ in range(rng.randrange(1, 40)):
            seq += rng.randrange(1, 4)
            if not begun or rng.random() < 0.3:
                turn, begun = turn + begun, True
                events.append((conv, seq, turn, "open", rng.choice(["user", "assistant"]), None))
                continue
            kind = rng.choice(["delta"] * 6 + ["edit", "regenerate"])
            if kind != "delta":
                turn = rng.randrange(turn + 1)  # what came after it is taken back
            events.append((conv, seq, turn, kind, None, None if kind == "regenerate" else rng.choice(PARTS)))
    shuffled = rng.sample(events, len(events))
    assert said(chat.format_chats(log(spark, *shuffled).repartition(7))) == folded(events)


def test_a_table_of_messages_goes_through_the_log(spark):
    rows = [(1, 0, "user", "a" * 4001), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "</s>"), (2, 0, None, None), (None, None, "user", "n"), (5, 0, "assistant", "🙂" * 2000)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chat.summarise(chat.format_chats(chat.as_events(messages))).collect()}
    for conv in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        whole, loss = "".join(f"{a}\n{b}\n" for a, b in mine), "".join(b for a, b in mine if a == "assistant")
        got = found[conv]
        assert (got["n_turns"], got["turns_sha256"]) == (len(mine), hashlib.sha256(whole.encode()).hexdigest())
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got["formatted_chars"] == sum(len(chat.render(*m)[0]) for m in mine)


# --- urls ------------------------------------------------------------------------------------

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/a/b", "block"), ("org", "/a/", "allow"),
    ("x.org", "/", "allow"), ("x.org", "/", "block"), ("com", "", "block"), (None, "/", "block"), ("com", "", "block"),
]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in RULES if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[3], best[4]) if best else (host, path, None, "allow")


URLS = [
    "http://A.NET/x", "https://www.example.net/en/1?x=/de/", "https://example.net/en", "https://example.net", "http://net/", "http://fnet/", "ftp://org/a/b",
    "ftp://b.org/a/bc#z", "ftp://b.org/a/", "x.org/", "http://x.org/", "http://www.x.org/a/b/c", "http://com", "http://.com?", "a://b://c.com/", "http://Ünï.net/ü",
    None, "", "://", "http:///a", "http://h\n.net/p\nq", "http://net/" + "a/" * 3000, "http://" + "a." * 500 + "net/",
]


def test_urls_against_every_rule(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string, verdict string")
    found = judge_urls(pages, spark.createDataFrame(RULES, RULE)).collect()
    assert len(found) == 2 * len(URLS)
    for r in found:
        assert tuple(r["judged"]) == judge(r["url"]), r["url"]


def test_columns_of_pages_stay_whatever_their_names(spark):
    names = ["page_id", "url", "h", "p", "best", "judged", "host", "path", "rule", "verdict", "page", "a.b", "prefix", "full", "digest"]
    rows = [(i, u, *(f"{n}{i}" for n in names[2:])) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, " + ", ".join(f"`{n}` string" for n in names[2:]))
    found = judge_urls(pages, spark.createDataFrame(RULES, RULE))
    assert found.columns == [n for n in names if n != "judged"] + ["judged"]
    for r in found.collect():
        assert tuple(r)[:-1] == tuple(x for x, n in zip(rows[r["page_id"]], names, strict=True) if n != "judged")
        assert tuple(r["judged"]) == judge(r["url"]), r["url"]


def test_no_rules_or_no_pages(spark):
    none = spark.createDataFrame([], RULE)
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert tuple(judge_urls(pages, none, otherwise="block").first()["judged"]) == ("a.b", "/c", None, "block")
    assert judge_urls(pages.limit(0), spark.createDataFrame(RULES, RULE)).collect() == []
