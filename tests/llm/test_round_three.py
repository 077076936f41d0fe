"""Cases that went wrong before: masks, repeated ids, thin sources, the word memory."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from huddle.llm import packing, warc
from huddle.llm.jaccard import jaccard_components, one_of_each
from huddle.llm.licences import scan_licences
from huddle.llm.mixing import mix_sources
from huddle.llm.secrets import redact
from huddle.llm.text import texts_of

ALPHABET = list("abzÉéßñ×÷ÿÀȏɏĀʰ0129 \n\t'\"!$%&#*()[]{}<>|/\\-_.,;:?@^`~+=") + ["'s", "'ll", "<|endoftext|>", "<|", "|>", "日", "本", "€", "…", "́", "̸", "ﬁ", "İ", "ſ", " ", "<|StartOfText|>", "Ǆ"]


@pytest.mark.parametrize("remembered", [600_000, 500])
def test_word_encoder_equals_the_tokenizer(monkeypatch, remembered):
    """Also where words are forgotten again and again."""
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 24))) for _ in range(20_000)]
    encoder, expected = packing.WordEncoder(path), [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for lo in range(0, len(texts), 1000):
        ids, counts = encoder.encode(texts_of(pa.array(texts[lo : lo + 1000])))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected[lo : lo + 1000]
    assert len(encoder.code) == len(encoder.uses) == len(encoder.start)


def test_encoder_outlives_the_module_copy():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.WordEncoder.kept(path) is packing.WordEncoder.kept(path)


def test_redact_masks_secrets_that_hold_others_whole(spark):
    a, b = "f3c2b1a9d8e7f605142a", "0a1b9c3d4e5f6a7bf3c2b1a9d8e7f605142a"
    text = f'password = "{a}" and api_key = "{b}" end'
    rows = [(1, text, "s"), (1, "another text of the id", "s"), (None, text, None), (None, f'token="{b[::-1]}"', "s"), (2, None, "s"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = redact(docs).collect()
    masked = 'password = "[SECRET]" and api_key = "[SECRET]" end'
    assert sorted(((r.doc_id or 0), r.text or "") for r in found) == sorted([(1, masked), (1, "another text of the id"), (0, masked), (0, 'token="[SECRET]"'), (2, ""), (3, "")])


def _text(rng, n=200):
    return [rng.choice("abcdefghijklmnop") + rng.choice("qrstuvwxyz") + str(rng.randint(0, 99)) for _ in range(n)]


def test_repeated_ids_keep_the_links_of_all_their_texts(spark):
    rng = random.Random(8)
    a, b, c = (_text(rng) for _ in range(3))
    near = lambda t: " ".join([*t[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(b)), (3, near(a)), (0, " ".join(a)), (1, " ".join(c)), (4, near(c)), (5, "alone in the world"), (1, " ".join(a)), (None, " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard_components(docs).collect()
    assert {(r.id, r.component) for r in found} == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 5), (None, None)} and len(found) == len(rows)
    without = spark.createDataFrame([r for r in rows if r[0] != 0], "doc_id long, text string")
    assert {(r.id, r.component) for r in jaccard_components(without).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (None, None)}
    kept = one_of_each(without, percent=90, width=3).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(c)), (5, "alone in the world"), (0, " ".join(a))])


def test_many_thin_sources_reach_their_targets(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for source in range(600):
        for _ in range(40 if source < 100 else 15):
            rows.append((n, " ".join(["w"] * rng.randint(1, 5 if source < 100 else 60)), f"s{source:04d}"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got, of = mix_sources(docs).collect(), {r[0]: r[2] for r in rows}
    taken, target = dict.fromkeys(of.values(), 0), {}
    for r in got:
        taken[of[r._id]] += r._taken
        target[of[r._id]] = r._target
        assert 0 <= r._taken <= 2 * r._size
    off = {s: abs(taken[s] - t) / t for s, t in target.items() if t}
    assert max(off.values()) < 0.05, sorted(off.items(), key=lambda x: -x[1])[:5]
    again = {r._id: r._taken for r in mix_sources(docs.repartition(7)).collect()}
    assert again == {r._id: r._taken for r in got}


@pytest.mark.parametrize("limit", [50_000, 0])
def test_keepers_by_broadcast_and_by_salted_join(spark, monkeypatch, limit):
    monkeypatch.setattr(warc, "COPIES", 7)
    monkeypatch.setattr(warc._with_keepers, "__defaults__", (limit,))
    rows = [(i, f"u{i}", None if i % 3 == 0 else f"text {i % 5}" if i % 3 == 1 else f"alone {i}") for i in range(120)] + [(None, None, None), (119, "u119", "alone 119")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    keeper = {}
    for page, _, html in rows:
        keeper.setdefault(html or "", []).append(-1 if page is None else page)
    want = [(page, len(html or ""), "response" if page == max(keeper[html or ""]) else "revisit", None if page == max(keeper[html or ""]) else max(keeper[html or ""])) for page, _, html in rows]
    got = warc.archive_round_trip(df).collect()
    assert sorted(((r.page, r.payload_bytes, r.type, r.refers_to) for r in got), key=str) == sorted(want, key=str) and all(r.intact for r in got)


def test_a_revisit_names_the_address_of_its_response(spark):
    found = list(warc.parse(b"\r\n\r\n".join(warc.page_records(1, "u1", b"x", 2, "u2", True, 100))))
    assert [(r["type"], r["refers_to"]) for r in found] == [("revisit", 2)]
    assert b"WARC-Refers-To-Target-URI: u2" in warc.page_records(1, "u1", b"x", 2, "u2", True, 100)[0]


def test_licence_families_that_share_words(spark):
    said = {
        "This library is licensed under the GNU Lesser General Public License, version 2.1": ["lgpl"],
        "You should have received a copy of the GNU Affero General Public License along with this program": ["agpl"],
        "You should have received a copy of the GNU General Public License along with this program": ["gpl"],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["mpl"],
        "Released under the terms of the Eclipse Public License 2.0": ["epl"],
        "Licensed under the ISC License.": ["isc"],
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse products": ["bsd"],
        "Licensed under CC BY-SA 4.0.": ["cc-by-sa"],
        "Licensed under CC BY 4.0.": ["cc-by"],
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.": ["cc-by-nc-nd"],
        "Licensed under the ISC License. Released under the terms of the Eclipse Public License 2.0.": ["isc", "epl"],
        "Released under the MIT License. Licensed under the Zlib License. Released under the MIT License.": ["mit", "unknown", "mit"],
    }
    filler = [(100 + i, " ".join(_text(random.Random(i), 5 + i % 30))) for i in range(200)]
    docs = spark.createDataFrame([*enumerate(said), *filler], "doc_id long, text string")
    got = {r.id: [h.family for h in r.hits] for r in scan_licences(docs).collect()}
    assert {t: got.pop(i) for i, t in enumerate(said)} == said and not any(got.values())


def test_licences_of_clashing_columns_repeated_and_very_long_texts(spark):
    long = " ".join(_text(random.Random(1), 60_000)) + " Released under the MIT License. " + " ".join(_text(random.Random(2), 20_000))
    rows = [(1, long, "a", 5), (1, long, "b", 6), (2, "Released under the MIT License.", None, None)]
    found = scan_licences(spark.createDataFrame(rows, "doc_id long, text string, id string, hits int")).collect()
    assert [(r.id, r.n_paragraphs, [h.family for h in r.hits]) for r in sorted(found, key=lambda r: r.id)] == [(1, 1, ["mit"])] * 2 + [(2, 1, ["mit"])]
