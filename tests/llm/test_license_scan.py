import duckdb
import numpy as np
import pytest

from moodline.llm import license_scan as ls
from moodline.llm import oracle, queries
from moodline.llm.textbuf import words
from tests.conftest import SF_SMALL


def _accepts(template, text):
    data = np.frombuffer(text.encode(), np.uint8)
    found = words(data, np.array([0, len(data)]))
    return bool(ls.template_places(found, ls.compiled("x", template)))


@pytest.mark.parametrize(("text", "yes"), [
    ("please permit use by anyone", True), ("please permit free use by anyone", True),
    ("please permit free use by some one", True), ("please permit use by", False),
    ("please permit use by a b c", True), ("permit, FREE use: by x", True), ("permit paid use by x", False),
    ("permit free free use by x", False), ("", False)])
def test_markup(text, yes):
    assert _accepts("[[please]] permit [[free]] use by {{who:2}}", text + " end" if yes else text) is (
        yes or _accepts("permit [[free]] use by", text))


def test_mandatory_wording_must_match_exactly():
    notice = ls.TEMPLATES["mit-text"]
    assert _accepts(notice, notice.upper().replace(" ", ", "))
    assert not _accepts(notice, notice.replace("granted", "given"))
    gpl = ls.TEMPLATES["gpl-notice"]
    assert _accepts(gpl, "This work is licensed under the GNU General Public License, version 3.")
    assert not _accepts(gpl, "licensed under the GNU Lesser General Public License")


BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
   disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of Example, Inc. nor the names of its contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL EXAMPLE, INC. BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def test_whole_wordings():
    three, two = ls.TEMPLATES["bsd-3-full"], ls.TEMPLATES["bsd-2-full"]
    clause = BSD[BSD.index("3. Neither"):BSD.index("THIS SOFTWARE")]
    assert _accepts(three, BSD) and not _accepts(two, BSD)
    assert _accepts(two, BSD.replace(clause, "")) and not _accepts(three, BSD.replace(clause, ""))
    assert _accepts(three, BSD.replace("1. ", "").replace("2. ", "* ").replace("3. ", "(c) "))
    assert not _accepts(three, BSD.replace("TORT", "FORT")) and not _accepts(three, BSD[:-10])
    assert not _accepts(three, BSD.replace("EXAMPLE, INC.", "x " * 13))


@pytest.mark.parametrize("label", sorted(ls.TEMPLATES))
def test_each_template_accepts_its_own_wording_only(label):
    """With every optional part in and out, replaceable ones filled and empty; not with a mandatory word changed."""
    import re

    template = ls.TEMPLATES[label]
    with_all = re.sub(r"[{][{]\w+:(\d+)[}][}]", lambda m: "x " * int(m[1]), template.replace("[[", "").replace("]]", ""))
    bare = re.sub(r"[{][{].*?[}][}]", "", re.sub(r"\[\[.*?\]\](?!\])", "", template))
    if "]]" not in bare:  # a nested optional part
        assert _accepts(template, bare)
        for k in (0, len(bare.split()) // 2, len(bare.split()) - 1):
            changed = bare.split()
            changed[k] = "qqq"
            assert not _accepts(template, " ".join(changed))
    assert _accepts(template, with_all)


@pytest.mark.parametrize("bad", ["[[a b", "{{x:3}}"])
def test_bad_template(bad):
    with pytest.raises(ValueError):
        ls.compiled("x", bad)


@pytest.mark.parametrize("name", ["op3_shards", "op5_licenses", "op6_topk", "op11_quality", "op12_manifest",
                                  "op13_collocations"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = queries.queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want


def test_edges(docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "Apache-License apache\nlicense"), (4, "Ünder the MIT license. CC BY cc-by"),
                    (5, "w " * 300_000 + "mit license"), (4, "x"), (4, "x")])
    rows = {(r["doc_id"], r["n_words"]): r for r in ls.scan(docs).collect()}
    assert rows[1, 0]["first_word"] is None and rows[2, 0]["labels"] == "" and rows[2, 0]["score"] == 0
    assert (rows[3, 4]["n_base"], rows[3, 4]["first_word"], rows[3, 4]["last_word"]) == (2, 0, 2)
    assert rows[4, 8]["base_labels"] == "cc-by,mit" and rows[4, 8]["n_base"] == 3 and rows[4, 8]["score"] == 0.5
    assert rows[5, 300_002]["first_word"] == 300_000
    assert ls.scan(docs).count() == 7 and ls.scan(docs.where("false")).count() == 0
