import hashlib

from hypothesis import given
from hypothesis import strategies as st

from quillstone.llm import chat


@given(st.lists(st.tuples(st.text(st.sampled_from("ab\\<>/ \n") | st.characters(codec="utf-8"), max_size=20), st.sampled_from(["user", "assistant", "a<b>\\", ""])), max_size=5))
def test_turns_come_back(turns):
    formatted = "".join(chat.format_turn(role, [{"kind": "text", "value": text, "tokens": 0}])[0] for text, role in turns)
    assert list(chat.read_turns(formatted)) == [(role, text) for text, role in turns]


def test_control_strings_in_texts_are_harmless():
    said = r"\### Assistant: </turn> ok <turn user> <image 0 5>"
    formatted, _ = chat.format_turn("user", [{"kind": "text", "value": said, "tokens": 0}])
    assert formatted.count("</turn>") == 1 and list(chat.read_turns(formatted)) == [("user", said)]


def test_parts_become_placeholders_in_order():
    parts = [
        {"kind": "text", "value": "see ", "tokens": 0}, {"kind": "image", "value": "s3/a.png", "tokens": 576}, {"kind": "text", "value": " & <x>", "tokens": 0},
        {"kind": "audio", "value": "b.wav", "tokens": 90}, {"kind": "document", "value": None, "tokens": None},
    ]
    formatted, attachments = chat.format_turn("user", parts)
    assert formatted == "<turn user>\nsee <image 0 576> & \\<x\\><audio 1 90><document 2 0></turn>\n"
    assert [(a["kind"], a["ref"], a["tokens"], a["start"]) for a in attachments] == [("image", "s3/a.png", 576, 4), ("audio", "b.wav", 90, 25), ("document", "", 0, 37)]
    assert list(chat.read_turns(formatted)) == [("user", "see  & <x>")]


def test_odd_parts_do_not_fail(spark):
    parts = [None, {"kind": None, "value": "a<", "tokens": None}, {"kind": "video", "value": "c.mp4", "tokens": -3}, {"kind": "text", "value": None, "tokens": 1}, {"kind": "other", "value": None, "tokens": 7}]
    formatted, attachments = chat.format_turn(None, parts)
    assert formatted == "<turn >\na\\<<other 0 0><other 1 7></turn>\n" and list(chat.read_turns(formatted)) == [("", "a<")]
    assert [(a["kind"], a["ref"], a["tokens"]) for a in attachments] == [("video", "c.mp4", 0), ("other", "", 7)]
    rows = [(1, 0, "user", [tuple(p.values()) if p else None for p in parts], 5, "x"), (1, 1, "assistant", None, 5, "x"), (None, None, None, [], 5, "x")]
    schema = f"conv_id long, turn long, role string, parts {chat.PARTS}, n_turns int, formatted string"
    turns = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in chat.digests(turns).collect()}
    assert (got[1].n_turns, got[1].n_attachments, got[1].attachment_tokens, got[None].n_turns) == (2, 2, 7, 1)
    assert [r.formatted for r in chat.format_conversations(turns).where("conv_id = 1").orderBy("position").collect()] == [formatted.replace("<turn >", "<turn user>"), "<turn assistant>\n</turn>\n"]


def test_a_very_long_conversation(spark):
    turns = spark.range(20_000).selectExpr("7 as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('<', repeat('ab ', 20)) as text")
    r = chat.digests(chat.text_parts(turns)).first()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (20_000, 610_000, hashlib.sha256(("<" + "ab " * 20).encode() * 10_000).hexdigest())


def test_digests(spark):
    rows = [(1, 1, "assistant", "b<"), (1, 0, "user", None), (None, 3, None, "x"), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (1, 2, "assistant", "\\é" * 5000)]
    turns = chat.text_parts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.digests(turns).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n\nassistant\nb<\nassistant\n" + "\\é" * 5000 + "\n")
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 10_002, sha("b<" + "\\é" * 5000))
    assert (got[2].n_turns, got[2].loss_chars) == (2, 0) and got[None].n_turns == 1
    whole = chat.format_conversations(turns).where("conv_id = 1").orderBy("position").collect()
    assert sum(len(r.formatted) for r in whole) == got[1].formatted_chars and [r.loss for r in whole] == [False, True, True]
    assert chat.digests(chat.text_parts(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
