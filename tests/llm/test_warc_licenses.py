import re

import pytest

from llm_rows import EDGE, docs_of
from valuelens.llm import licenses, warc

PAGES = [
    (1, "http://a/1", '<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title><style>p{}</style></head><body><!-- <p>no</p> --><p>One&nbsp;two<br>three'
     '<script>var t="</p>";</script><ul><li><a class=x href="/u?a=1&amp;b=2">L1</a><li><a href=\'/v\'>L2</a></ul>&#233;&#x41; &amp;#65; &lt;b&gt;</body></html>'),
    (2, "http://a/2", ""),
    (3, None, None),
    (4, "http://a/4", "plain, no tags"),
    (4, "http://a/4", "plain, no tags"),
    (None, "http://a/5", "<p>unclosed <b"),
    (6, "http://a/6", "<p>" + "long " * 40000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, block string, record_type string")


def test_derivatives(spark, pages):
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(rows) == 2 * len(PAGES)
    one = {r.record_type: r for r in rows if r.page_id == 1}
    assert one["conversion"].block == "A & B\nOne two\nthree\nL1\nL2\néA &#65; <b>"
    assert one["metadata"].block == "http-status: 200\r\ntitle: A & B\r\nlanguage: en\r\noutlink: /u?a=1&b=2\r\noutlink: /v\r\n"
    response = {r.page_id: r for r in warc.responses(pages).collect()}[1]
    for r in one.values():
        assert r.refers_to == response.record_id and r.source_payload_digest == response.payload_digest and r.target_uri == "http://a/1"
        assert r.source_headers.startswith("HTTP/1.1 200 OK\r\nContent-Type: text/html") and not r.source_headers.endswith("\r\n")
        assert r.content_length == len(r.block.encode())
    assert len({r.record_id for r in rows}) == 2 * (len(PAGES) - 1)  # a repeated page gives the same records
    assert [r.block for r in rows if r.page_id == 3 and r.record_type == "conversion"] == [""]
    assert warc.derive(warc.responses(pages.where("page_id = 99"))).count() == 0


def test_records_round_trip(pages):
    made = warc.derive(warc.responses(pages))
    keys = ["record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length", "block_digest", "block"]
    want = made.select(*keys, made.source_payload_digest.alias("payload_digest"))
    got = warc.parse(warc.serialise(made)).select(*keys, "payload_digest")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_written_files_hold_the_records(pages, tmp_path):
    import glob
    import gzip

    made = warc.derive(warc.responses(pages))
    warc.write_warc(made, str(tmp_path / "w"))
    raw = b"".join(gzip.open(f).read() for f in sorted(glob.glob(str(tmp_path / "w" / "part*"))))
    at, n = 0, 0
    while at < len(raw):
        cut = raw.index(b"\r\n\r\n", at)
        size = int(re.search(rb"Content-Length: (\d+)", raw[at:cut])[1])
        assert raw[at:].startswith(b"WARC/1.1\r\n") and raw[cut + 4 + size : cut + 8 + size] == b"\r\n\r\n"
        at, n = cut + 8 + size, n + 1
    assert n == 2 * len(PAGES)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for phrase, label in licenses.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), sorted({x for _, x in at})


def test_base_phrases_equal_brute_force(spark):
    rows = [(1, "The GNU-General\nPublic  License, and the MIT License. CC BY cc/by"), (2, "mit licenses xmit license mit licenseé"), (3, "Apache License apache LICENSE"),
            (4, "gnu general public"), (5, "é cc by; İ CC--BY"), *[(100 + i, t) for i, (_, t) in enumerate(EDGE)]]
    for r in licenses.scan(docs_of(spark, rows)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(dict(rows)[r.doc_id]), r
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
    assert licenses.scan(docs_of(spark, EDGE)).count() == len(EDGE) and licenses.scan(docs_of(spark, [])).count() == 0


def test_rules_gate_and_settle():
    s = licenses.Scanner()
    assert len(s.rules) > 300
    labels = lambda t: sorted({s.rules[i].label for i, _, _ in s.detect(t.encode().lower())})
    assert labels("Licensed under the Apache License, Version 2.0 (the ...)") == ["apache-2.0"]  # the bare name lies within
    assert labels("Apache License") == ["apache"]
    assert labels("SPDX-License-Identifier: MIT\nCopyright 2020") == ["copyright", "mit"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc-4.0"]
    assert labels("gnu  general\npublic license version 3") == ["gpl-3.0"]
    assert labels("mit dem Auto") == []


def test_gate_loses_nothing():
    """Every rule alone finds in the notices what it finds through the gate."""
    s = licenses.Scanner()
    texts = [f"x {label} {spdx} licensed under the {spdx} spdx-license-identifier: {spdx} https://{address}/ y" for label, spdx, _, _, address in licenses.FAMILIES]
    for t in texts:
        low = t.encode()
        on = set()
        for _, numbers in s.gate.iter(low.decode("latin-1")):
            on.update(numbers)
        for i, r in enumerate(s.rules):
            assert i in on or not r.pattern.search(low), (r.label, r.keywords, t)


def test_optional_spaces_and_gates():
    """Forms with an optional space are found with and without it; every alternative of a rule has its keyword."""
    s = licenses.Scanner()
    labels = lambda t: {s.rules[i].label for i, _, _ in s.detect(t.encode().lower())}
    short = {"GPLv1": "gpl-1.0", "GPLv2": "gpl-2.0", "GPLv3": "gpl-3.0", "LGPLv2.0": "lgpl-2.0", "LGPLv2.1": "lgpl-2.1", "LGPLv3": "lgpl-3.0",
             "AGPLv3": "agpl-3.0", "MPLv1.1": "mpl-1.1", "MPLv2": "mpl-2.0", "EPLv1": "epl-1.0", "EPLv2": "epl-2.0", "CPLv1": "cpl-1.0",
             "EUPLv1": "eupl-1.2", "AFLv3": "afl-3.0", "OSLv3": "osl-3.0", "UPLv1": "upl-1.0", "OpenRAIL license": "openrail"}
    cc = {"ShareAlike 3.0": "cc-by-sa-3.0", "ShareAlike 4.0": "cc-by-sa-4.0", "NoDerivatives 4.0": "cc-by-nd-4.0", "NonCommercial 3.0": "cc-by-nc-3.0",
          "NonCommercial 4.0": "cc-by-nc-4.0", "NonCommercial-ShareAlike 4.0": "cc-by-nc-sa-4.0", "NonCommercial-NoDerivatives 4.0": "cc-by-nc-nd-4.0"}
    for text, label in [*short.items(), *((f"Creative Commons Attribution-{k}", v) for k, v in cc.items())]:
        assert label in labels(f"x {text}, y"), text
        assert label in labels(f"available under the {text}."), text
    for text, label in (("GPL v2", "gpl-2.0"), ("GPL  3", "gpl-3.0"), ("Creative Commons Attribution Share Alike 4.0", "cc-by-sa-4.0"), ("CC  BY\n4.0", "cc-by-4.0"),
                        ("available under GPL-2.0", "gpl-2.0"), ("for academic purposes only", "research-only"), ("llama 2 community license", "llama")):
        assert label in labels(text), text
    for label, spdx, *_ in licenses.FAMILIES:
        for gap in ("", " ", "\n\t"):
            assert label in labels(f"SPDX-License-Identifier:{gap}{spdx}"), spdx
            assert 100 in {s.rules[i].priority for i, _, _ in s.detect(f"spdx-license-identifier:{gap}{spdx}".encode())}, spdx
        assert max(s.rules[i].priority for i, _, _ in s.detect(f"available under {spdx} x".encode())) >= 88, spdx
    assert "apache-2.0" not in labels("apache+2.0")


def test_containment():
    d = lambda p, i, a, b: (p, b - a, -i, a, b)
    strong, inside, across, after = d(9, 0, 10, 50), d(5, 1, 20, 30), d(5, 2, 40, 60), d(1, 3, 70, 80)
    assert licenses.settle([after, inside, across, strong]) == [strong, across, after]
    assert licenses.settle([d(5, 1, 0, 9), d(5, 0, 0, 9)]) == [d(5, 0, 0, 9)]
    assert licenses.settle([d(5, 1, 0, 9), d(9, 0, 2, 4)]) == [d(5, 1, 0, 9), d(9, 0, 2, 4)]
