from pulse.llm import chat


def turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 2, "bob", "hi <|im_end|>"), (1, 1, "ann", "hello"), (1, 3, "al ice\n<|x|>", None), (1, 2, "bob", "again"),
            (2, 0, "system", "alone"), (None, 5, "ann", "solo"), (None, 5, "ann", "solo"), (3, None, None, "late"), (3, 0, " ", "é"),
            (4, 0, "ann", "a"), (4, 300, "bob", "b")]
    return spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, solo int")


def test_every_participant_takes_the_assistants_place(spark):
    rows = chat.rotate(turns(spark)).collect()
    by = {(r.conv_id, r.perspective, r.part): r for r in rows}
    assert sorted({r.perspective for r in rows if r.conv_id == 1}) == ["al ice\n<|x|>", "ann", "bob"]
    assert not [r for r in rows if r.conv_id == 2] and len([r for r in rows if r.conv_id is None]) == 2
    bob = by[1, "bob", 0]
    assert bob.text == ("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name=ann\nhello<|im_end|>\n"
                        "<|im_start|>assistant\nagain<|im_end|>\n<|im_start|>assistant\nhi <im_end><|im_end|>\n"
                        "<|im_start|>user name=al_ice_x_\n<|im_end|>\n")
    assert [bob.text[s.start:s.stop] for s in bob.loss_spans] == ["again<|im_end|>", "hi <im_end><|im_end|>"]
    assert (bob.n_turns, bob.n_target_turns) == (5, 2)
    last = by[1, "al ice\n<|x|>", 0]
    assert [last.text[s.start:s.stop] for s in last.loss_spans] == ["<|im_end|>"]


def test_null_roles_numbers_and_parts(spark):
    by = {(r.conv_id, r.perspective, r.part): r for r in chat.rotate(turns(spark)).collect()}
    assert by[3, "unknown", 0].text == "<|im_start|>assistant\né<|im_end|>\n"
    assert by[3, "unknown", chat._LAST].text == "<|im_start|>assistant\nlate<|im_end|>\n"
    # a long dialogue comes in parts, each from every perspective
    assert by[4, "ann", 0].n_target_turns == 1 and by[4, "ann", 1].n_target_turns == 0 and by[4, "bob", 1].n_target_turns == 1


def test_empty_table_and_plan(spark):
    assert chat.rotate(turns(spark).limit(0)).count() == 0
    plan = chat.rotate(turns(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
