"""Tool-call linking and license scans: by hand, and their plans hold no Python."""

import json

from tests.llm.fixtures import with_clashes, with_every_clash
from tillbook.llm import licenses, toolcalls
from tillbook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA_ROWS = [("add", "a", "integer", True), ("add", "b", "number", False), ("say", "text", "string", True), ("say", "tags", "array", False), ("say", "deep", "object", False)]


def linked(spark, calls, results):
    rows = toolcalls.link(
        with_clashes(spark.createDataFrame(calls, toolcalls.CALLS)), with_clashes(spark.createDataFrame(results, toolcalls.RESULTS)),
        spark.createDataFrame(SCHEMA_ROWS, toolcalls.SCHEMAS),
    ).collect()
    return {(r.conv_id, r.call_id, r.turn, r.status): r for r in rows}


def test_links_levels_and_json(spark):
    found = linked(spark, [
        (1, "x", 1, "add", '{"b": 2.5, "a": 1}'),
        (1, "y", 3, "say", '{"text": "$x", "tags": ["$z"]}'),
        (1, "z", 5, "add", '{"a": "$x"}'),
        (1, "x", 9, "add", '{"a": 3}'),
        (2, "x", 1, "say", '{"text": "é \\n \\"q\\"", "deep": {"b": 1, "a": [null, true]}}'),
        (2, "c", 2, "say", '{"text": "$d"}'), (2, "d", 3, "say", '{"text": "$c"}'), (2, "e", 4, "say", '{"text": "$c"}'), (2, "self", 5, "say", '{"text": "$self"}'),
        (2, "lost", 6, "say", '{"text": "$nowhere"}'),
    ], [(1, "x", 2, "3.5"), (1, "x", 4, "later"), (1, "z", 6, None), (2, "q", 7, "alone"), (3, "x", 2, "other chat")])
    x = found[1, "x", 1, "linked"]
    assert (x.after_turn, x.step, x.result_turn, x.errors) == (1, 0, 2, [])
    assert x.json == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"3.5"}'
    z, y = found[1, "z", 5, "linked"], found[1, "y", 3, "unanswered"]
    assert (z.after_turn, z.step, z.errors) == (5, 0, ["mistyped a"])
    assert (y.after_turn, y.step) == (5, 1)
    assert found[1, "x", 9, "duplicate"].after_turn is None
    assert json.loads(found[2, "x", 1, "unanswered"].json)["arguments"] == {"text": 'é \n "q"', "deep": {"a": [None, True], "b": 1}}
    assert found[2, "x", 1, "unanswered"].json.index('"deep":{"a":') > 0
    assert [found[2, c, t, "unanswered"].after_turn for c, t in (("c", 2), ("d", 3), ("e", 4), ("self", 5), ("lost", 6))] == [None, None, None, None, 6]
    assert found[2, "q", 7, "orphan"].json == '{"id":"q","result":"alone"}' and (3, "x", 2, "orphan") in found
    assert len(found) == 12


def test_call_edge_cases(spark):
    found = linked(spark, [
        (None, "a", 1, "add", '{"a": 1}'), (1, None, 1, "add", "{}"), (1, "b", 2, "add", "no json"), (1, "c", 3, "add", None), (1, "d", 4, "none", "{}"),
        (1, "e", 5, None, '{"a": 1}'), (1, "f", 6, "say", '{"text": 5, "more": 1}'), (1, "f", 6, "say", '{"text": 5, "more": 1}'), (1, "g", None, "add", '{"a": 9}'),
        (1, "h", 8, "say", json.dumps({"text": "long " * 50_000})),
    ], [(None, "a", 2, "r"), (1, None, 2, "r"), (1, "c", 9, "r"), (1, "c", 9, "r")])
    assert found[None, "a", 1, "unanswered"].after_turn is None and (None, "a", 2, "orphan") in found and (1, None, 2, "orphan") in found
    assert found[1, None, 1, "unanswered"].errors == ["missing a"]
    assert found[1, "b", 2, "unanswered"].errors == ["unreadable arguments"] == found[1, "c", 3, "linked"].errors
    assert found[1, "d", 4, "unanswered"].errors == ["unknown tool"] == found[1, "e", 5, "unanswered"].errors
    assert found[1, "f", 6, "unanswered"].errors == ["mistyped text", "unknown more"]
    assert (found[1, "g", None, "unanswered"].after_turn, found[1, "g", None, "unanswered"].step) == (None, 0)
    assert len(found) == 11
    assert linked(spark, [], []) == {}


def test_topological_order(spark):
    """Random references, both ways: sorted by the result's order, no call comes before one it needs."""
    import random

    choose = random.Random(7)
    calls, needs = [], {}
    for conv in range(30):
        rank = choose.sample(range(8), 8)
        for k in range(8):
            needs[conv, f"c{k}"] = {f"c{j}" for j in range(8) if rank[j] < rank[k] and choose.random() < 0.25}
            calls.append((conv, f"c{k}", choose.randint(0, 4), "say", json.dumps({"text": "t", "tags": [f"${n}" for n in sorted(needs[conv, f"c{k}"])]})))
    done = {}
    for (conv, call, turn, _), r in sorted(linked(spark, calls, []).items(), key=lambda x: (x[0][0], x[1].after_turn, x[1].step, x[0][1])):
        assert needs[conv, call] <= done.setdefault(conv, set())
        assert r.after_turn >= turn
        done[conv].add(call)
    assert all(len(d) == 8 for d in done.values())


def test_hot_identifier(spark):
    found = linked(spark, [(1, "x", t, "add", '{"a": 1}') for t in range(300)], [(1, "x", t, str(t)) for t in range(300)])
    assert sum(k[3] == "linked" for k in found) == 1 and sum(k[3] == "duplicate" for k in found) == 299


def test_calls_in_messages(spark):
    messages = spark.createDataFrame([
        (1, 0, "user", "hi"), (1, 1, "assistant", '{"tool_calls": [{"id": "x", "name": "add", "arguments": {"a": 1}}, {"id": "y", "name": "say", "arguments": {"text": "$x"}}]}'),
        (1, 2, "tool", '{"tool_call_id": "x", "content": "2"}'), (1, 3, "assistant", "done"), (1, 4, "tool", "not json"), (None, None, None, None),
    ], "conv_id long, turn long, role string, text string")
    calls, results = toolcalls.parse_messages(messages)
    found = toolcalls.link(calls, results, spark.createDataFrame(SCHEMA_ROWS, toolcalls.SCHEMAS)).collect()
    assert sorted((r.call_id, r.status, r.after_turn, r.step, r.errors) for r in found) == [("x", "linked", 1, 0, []), ("y", "unanswered", 1, 0, [])]


def scanned(spark, files):
    df = with_clashes(spark.createDataFrame(files, "file_id long, path string, text string"))
    rows = licenses.scan(df, licenses.templates(spark)).collect()
    return {r.file_id: (r.own_license, r.license, r.inherited_from) for r in rows}, rows


def test_nearest_license_wins(spark):
    mit, apache, gpl = "Released under the MIT License.", "code\n# Licensed under the Apache License, Version 2.0.\nmore", "This work is licensed under the GNU General Public License, version 3."
    found, rows = scanned(spark, [
        (1, "LICENSE", mit), (2, "a/b/c/file.py", "text"), (3, "a/LICENSE.txt", gpl), (4, "a/b/own.py", apache), (5, "b/x.py", "nothing"),
        (6, "a/b/COPYING", "nothing of the kind"), (7, "ab/file", "licensed to nobody at all in this town"), (8, None, mit), (9, "a/file", None), (10, "c/LICENSE", None),
        (11, "d/LICENSE", apache), (11, "d/LICENSE", mit), (None, "d/y", ""),
    ])
    assert found[1] == ("MIT", "MIT", None) and found[2] == (None, "GPL-3.0", "a") and found[4] == ("Apache-2.0", "Apache-2.0", None)
    assert found[5] == (None, "MIT", "") and found[6] == (None, "GPL-3.0", "a") and found[7] == (None, "MIT", "")
    assert found[8] == ("MIT", "MIT", None) and found[9] == (None, "GPL-3.0", "a") and found[10] == (None, "MIT", "")
    # both rows of file 11 share the best match, the first by name of equal ones
    assert found[11] == ("Apache-2.0", "Apache-2.0", None) and found[None] == (None, "Apache-2.0", "d")
    assert len(rows) == 13


def test_every_template_matches_itself(spark):
    found, _ = scanned(spark, [(i, f"f{i}", f"// {text.upper()} \nx") for i, (_, text) in enumerate(licenses.TEMPLATES)])
    assert [found[i][0] for i in range(len(licenses.TEMPLATES))] == [name for name, _ in licenses.TEMPLATES]


def commented(mark, text):
    return "\n".join(f"{mark} {line}" for line in text.split("\n")) + "\nimport x\n"


GPL_HEADER = """Frob - a tool for frobbing
Copyright (C) 1999 Jane Doe

Frob is free software; you may redistribute it and/or modify it
under the terms of the GNU General Public License as published
by the Free Software Foundation; either version 2, or (at your option)
any later version.

Frob is distributed in the hope that it will be of use, but
WITHOUT ANY WARRANTY."""
MIT_BODY = """Copyright 2011 The Frob Authors

Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files, to deal in
the Software without restriction, including the rights to use, copy,
modify, merge, publish, distribute and sell copies of the Software,
subject to the following conditions:

This copyright notice shall be included in all copies of the Software."""
BSD_BODY = """Copyright (c) 1990 The Regents of Frob

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that these conditions are met:
- Redistributions of source code must retain the above copyright
  notice and this list of conditions.
- Redistributions in binary form must reproduce the above copyright
  notice and this list of conditions in the documentation.
{}
THIS SOFTWARE IS PROVIDED BY THE REGENTS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING THE IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS FOR A PARTICULAR PURPOSE, ARE DISCLAIMED. IN NO EVENT SHALL
THE REGENTS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL OR
CONSEQUENTIAL DAMAGES (INCLUDING PROCUREMENT OF SUBSTITUTE GOODS, LOSS OF
USE, DATA, OR PROFITS) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT OR TORT, ARISING OUT OF THE USE OF THIS SOFTWARE."""
BSD_NAMES = """- Neither the name of Frob nor the names of contributors may be used to
  endorse or promote products derived from this software without prior
  written permission.
"""


def test_other_wordings_in_blocks_and_files(spark):
    """None of these is a template's own text, and all stand below a directory of another license."""
    agpl = GPL_HEADER.replace("General", "Affero General").replace("version 2", "version 3")
    lesser = GPL_HEADER.replace("General", "Lesser General").replace("version 2", "version 2.1")
    permitted = "Permission to use, copy, modify and distribute this software for any purpose is hereby granted, provided that\nthe above copyright notice and this permission notice appear in all copies of it."
    cases = [
        ("a.c", "SPDX-License-Identifier: MIT", "MIT"), ("a.c", "// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("a.c", "/* SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */", "GPL-2.0"),
        ("a.c", "# spdx-license-identifier: (MPL-2.0 OR MIT)", "MIT"), ("a.html", "<!-- SPDX-License-Identifier: CC-BY-SA-4.0-->", "CC-BY-SA-4.0"),
        ("a.c", "# SPDX-License-Identifier: LicenseRef-Frob", None), ("README", "The Mozilla Public License, Version 2.0", "MPL-2.0"),
        ("a.py", commented("#", GPL_HEADER), "GPL-2.0"), ("a.c", f"/*\n{GPL_HEADER}\n*/\nint x;", "GPL-2.0"), ("a.c", commented(" *", agpl), "AGPL-3.0"),
        ("a.py", f'"""Frob.\n\n{lesser}\n"""\nimport x', "LGPL-2.1"), ("a.el", commented(";;", MIT_BODY), "MIT"), ("LICENSE", MIT_BODY, "MIT"),
        ("a.c", commented("//", BSD_BODY.format("")), "BSD-2-Clause"), ("LICENSE", BSD_BODY.format(BSD_NAMES), "BSD-3-Clause"),
        ("a.sql", commented("--", permitted), "ISC"), ("COPYING", "\tGNU General Public License\r\n\tVersion 3, 29 Jun 2007\r\n\r\nPreamble\r\n\r\n" + "words of it\r\n" * 300, "GPL-3.0"),
        ("LICENSE", "Legal Code\n\nCC0 1.0 Universal:\n\nStatement of Purpose\n" + "words of it\n" * 300, "CC0-1.0"),
        ("a.py", "# Copyright 2020 Frob Inc. All rights reserved.\n# This file is confidential and may not be\n# copied or shared with third parties.", None),
        ("a.py", commented("#", "words\n" * 20_000 + "\nlicense"), None),
    ]
    found, _ = scanned(spark, [(-1, "LICENSE", "Licensed under the EPL 2.0, the Eclipse Public License, version 2.0.")] + [(i, f"{i}/{name}", text) for i, (name, text, _) in enumerate(cases)])
    assert [found[i] for i in range(len(cases))] == [(own, own or "EPL-2.0", None if own else "") for _, _, own in cases]


def test_no_files(spark):
    assert scanned(spark, []) == ({}, [])


def test_plans_hold_no_python(spark):
    for name in ("op7_tool_call_linking", "op10_license_scan"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop")), name


def test_messages_with_columns_of_every_name(spark):
    messages = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    schemas = spark.createDataFrame(SCHEMA_ROWS, toolcalls.SCHEMAS)

    def found(rows):
        spoken, written = toolcalls.exchanges(rows), toolcalls.parse_messages(rows)
        return sorted(map(str, toolcalls.link(spoken[0].unionByName(written[0]), spoken[1].unionByName(written[1]), schemas).collect()))

    assert found(with_every_clash(messages)) == found(messages)


def test_no_join_is_forced(spark):
    plan = QUERIES["op7_tool_call_linking"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=" not in plan
