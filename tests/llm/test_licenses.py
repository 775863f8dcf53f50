import random

from ledgerlens.llm import licenses as L

MIT = L.TEMPLATES["MIT"][2]


def places(llm, texts):
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in L.license_report(df).collect()}


def test_notices_are_found_with_their_wording(llm):
    wrapped = "\n".join(MIT[i:i + 70] for i in range(0, len(MIT), 70))
    broken = MIT.replace("free of charge", "without any charge").replace("\n", " ")
    other = MIT.replace("merge, publish, distribute, sublicense, and/or sell copies of", "and run, but in no way whatever to change, pass on, rent out or offer for sale,")
    got = places(llm, [f"Some words first. {MIT} And more.", broken, "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.",
                       "The license of this text is not stated.", "RELEASED under the\nMIT License", other, None, "", wrapped])
    assert got[0].licenses == "MIT" and got[0].spans[0].differences == []
    text = f"Some words first. {MIT} And more.".encode()
    assert text[got[0].spans[0].start:got[0].spans[0].end].decode() + "." == MIT
    assert got[1].licenses == "MIT" and got[1].spans[0].differences == ["free of > without any"]
    assert got[2].licenses == "CC-BY-4.0,CC-BY-NC-4.0" and got[2].n_licenses == 2
    assert got[4].licenses == "MIT"
    assert [got[i].licenses for i in (3, 5, 6, 7)] == [""] * 4


def test_short_notices_equal_a_plain_search(llm, docs):
    short = [t for t in L.templates(L.TEMPLATES) if len(t.words) <= L.SHORT]
    got = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in L.license_report(docs).collect()}
    for r in docs.collect():
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in (r.text or "").encode())
        joined = b" " + b" ".join(L.WORD.findall(low)) + b" "
        assert got[r.doc_id] == {t.license for t in short if b" " + b" ".join(t.words) + b" " in joined}


def windows_with_runs(docs, times=12):
    """Each run that a place must keep, in windows of other words: of documents, and of other notices in any order."""
    rng = random.Random(5)
    scanner = L.Scanner(L.TEMPLATES)
    plain = [w for r in docs.orderBy("doc_id").collect() for w in L.WORD.findall((r.text or "").lower().encode())]
    legal = [w for t in scanner.templates for w in t.words]
    for which, template in enumerate(scanner.templates):
        for run in template.runs:
            for k in range(times):
                source = (plain, legal)[k % 2]
                at = rng.randrange(len(source) - scanner.window)
                around = source[at:at + scanner.window - len(run)]
                if k % 4 == 1:
                    rng.shuffle(around)
                cut = rng.choice((0, len(around), rng.randrange(len(around) + 1)))
                yield scanner, which, run, [*around[:cut], *run, *around[cut:]]


def test_the_bound_on_savings_loses_no_run(docs):
    """A window that holds a run saves at least the bound with the run's template."""
    for scanner, which, run, window in windows_with_runs(docs):
        assert dict((i, saved) for saved, i in scanner.ranked(b" ".join(window)))[which] >= L.LEAST_SAVED, run


def test_every_run_has_a_cue_and_a_window():
    scanner = L.Scanner(L.TEMPLATES)
    for t in scanner.templates:
        for run in t.runs:
            assert set(run) & set(scanner.cues) and len(run) + L.STEP <= scanner.window


def test_cues_come_from_the_templates(llm):
    """A caller's template of words that no license uses is found, also wrapped, commented and far from its cue."""
    own = ("Anybody willing to cook with these recipes must first telephone grandmother, who decides about every helping, and afterwards wash up "
           "thoroughly, leaving neither crumbs nor complaints behind, whatever visitors may say of the gravy.")
    wrapped = "\n".join(f"{' ' * 200}# {word}" for word in own.split())
    texts = [f"before {own} after", wrapped, own.replace("gravy", "soup"), "nothing of that kind"]
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in L.license_report(df, texts={"Kitchen": [own]}).collect()}
    assert [got[i].licenses for i in range(4)] == ["Kitchen", "Kitchen", "Kitchen", ""]
    assert got[2].spans[0].differences == ["gravy > soup"]


def test_whole_license_texts(llm):
    whole = {name: max(notices, key=len) for name, notices in L.TEMPLATES.items() if name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Unlicense")}
    texts = [f"Copyright (c) 2020 Somebody\n\n{text.replace('. ', chr(10) + '.  ')} tail" for text in whole.values()]
    got = places(llm, texts)
    for i, (name, text) in enumerate(whole.items()):
        assert got[i].licenses == name and got[i].n_licenses == 1
        assert got[i].spans[0].end - got[i].spans[0].start >= len(text) - 2


def test_without_compression_nothing_is_found(monkeypatch):
    """The savings decide which templates are looked for ..."""
    block = f"some words {MIT} and more. Licensed under CC BY 4.0.".lower().encode()
    assert [s["license"] for s in L.Scanner(L.TEMPLATES).scan(block)] == ["MIT", "CC-BY-4.0"]
    monkeypatch.setattr(L.Scanner, "saves", lambda self, text, which, alone: 0)
    assert L.Scanner(L.TEMPLATES).scan(block) == []


def test_savings_decide_which_license_wins(monkeypatch):
    """... and which of those that fit a place has it: the one that saves more, not the one with more words."""
    same = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega "
    near = f"{same}one two three four five six seven eight nine ten".split()
    other = list(near)
    other[8], other[20], other[28] = "wrong", "words", "here"
    block = " ".join(near).encode()
    two = {"A": [" ".join(other)], "B": [" ".join(near[:-1])]}
    assert [s["license"] for s in L.Scanner(two).scan(block)] == ["B"]
    before = L.Scanner.saves
    monkeypatch.setattr(L.Scanner, "saves", lambda self, text, which, alone: 1000 - before(self, text, which, alone))
    assert [s["license"] for s in L.Scanner(two).scan(block)] == ["A"]


def test_the_right_template_saves_most():
    scanner = L.Scanner(L.TEMPLATES)
    for t in scanner.templates:
        if len(t.words) > L.SHORT:
            assert scanner.templates[scanner.ranked(t.text)[0][1]].license == t.license


def test_many_notices_in_one_text_equal_a_plain_search(llm, docs):
    """A hundred notices, 500 characters apart: one block of more than 50 KB."""
    filler = " ".join(r.text or "" for r in docs.orderBy("doc_id").collect()).replace("licen", "")
    notices = [t for name in sorted(L.TEMPLATES) for t in L.TEMPLATES[name]]
    parts = [filler[i * 500:(i + 1) * 500] + " | " + notices[i % len(notices)] + " | " for i in range(100)]
    text = "".join(parts)
    got = places(llm, [text])[0].spans
    wanted, at = [], 0
    for part, notice in zip(parts, (notices[i % len(notices)] for i in range(100))):
        wanted.append((text.index(notice, at), next(name for name in L.TEMPLATES if notice in L.TEMPLATES[name])))
        at += len(part)
    raw = text.encode()
    assert len(filler) > 50_000
    assert [(len(raw[:s.start].decode()), s.license) for s in got] == wanted
    assert all(s.differences == [] for s in got)


def test_standard_notices_are_not_taken_for_another_license(llm):
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software "
           "Foundation, either version {} of the License, or (at your option) any later version.")
    lesser = gpl.replace("This program", "This library")
    bsd = next(t for t in L.TEMPLATES["BSD-2-Clause"] if t.startswith("Redistribution"))
    third = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
             "from this software without specific prior written permission.")
    end = " THIS SOFTWARE IS PROVIDED AS IS, and nobody may endorse it."
    wanted = [
        (gpl.format("General Public License", "3"), "GPL-3.0"), (gpl.format("General Public License", "2"), "GPL-2.0"),
        (gpl.format("Affero General Public License", "3"), "AGPL-3.0"), (gpl.format("Lesser General Public License", "3"), "LGPL-3.0"),
        (gpl.format("Lesser General Public License", "2.1"), "LGPL-2.1"), (lesser.format("Lesser General Public License", "2.1"), "LGPL-2.1"),
        (lesser.format("Library General Public License", "2"), "LGPL-2.0"), (lesser.format("General Public License", "3"), "GPL-3.0"),
        (gpl.format("Wider Affero Public License", "9"), ""), (bsd + end, "BSD-2-Clause"), (bsd.replace("1. ", "* ").replace("2. ", "* ") + end, "BSD-2-Clause"),
        (bsd + third + end, "BSD-3-Clause"), (bsd + third.replace("the copyright holder", "Example Corporation") + end, "BSD-3-Clause"),
        (bsd + " 3. The name of the author may not be used to endorse or promote products derived from this software without specific prior "
         "written permission." + end, "BSD-3-Clause"),
        ("// SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\nand isc", "Apache-2.0,MIT"), ("SPDX-License-Identifier: LicenseRef-Own AND ISC", "ISC"),
        ("SPDX-License-Identifier: MIT not Apache-2.0", "MIT"),
    ]
    got = places(llm, [text for text, _ in wanted])
    assert [got[i].licenses for i in range(len(wanted))] == [name for _, name in wanted]


def test_odd_rows(odd_docs, no_docs):
    assert L.license_report(odd_docs).count() == odd_docs.count()
    assert L.license_report(no_docs).count() == 0
