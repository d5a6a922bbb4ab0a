import random
import re

import pytest

from holdfast.llm import licenses
from holdfast.llm.licenses import CUES, TEMPLATES, WORD, differences, find_licenses, prepare, scan_text

MIT = next(text for name, text in TEMPLATES if name == "MIT" and len(text) > 100)
APACHE = next(text for name, text in TEMPLATES if name == "Apache-2.0" and len(text) > 100)


def found(df, **options):
    return sorted(((r["doc_id"], r["license"], r["missing_words"], r["added_words"]) for r in find_licenses(df, **options).collect()), key=repr)


def test_notices_are_found_in_any_layout(frame, prose):
    rows = [
        (1, f"{prose(300)}\nReleased under the MIT License.\n{prose(300)}"),
        (2, f"{prose(50)}\n" + MIT.replace(" ", "\n * ", 40).upper() + f"\n{prose(50)}"),
        (3, APACHE.replace("software distributed", "software that is distributed")),
        (4, "Licensed under CC BY-NC 4.0. " + prose(2000) + " All rights reserved."),
        (5, "Licensed under CC BY-SA 4.0."),
        (6, "We licensed the film and gave permission to copy it."),
        (7, None), (8, ""), (None, "Released under the BSD License."), (9, prose(400)),
        (10, "Released under the MIT License."), (10, "Released under the MIT License."),
        (11, "All rights reserved. " * 400),
    ]
    got = found(frame(rows))
    assert [g for g in got if g[0] != 11] == sorted(
        [(1, "MIT", 0, 0), (2, "MIT", 0, 0), (3, "Apache-2.0", 0, 2), (4, "CC-BY-NC-4.0", 0, 0), (4, "Proprietary", 0, 0), (5, "CC-BY-SA-4.0", 0, 0)]
        + [(10, "MIT", 0, 0)] * 2 + [(None, "BSD", 0, 0)],
        key=repr,
    )
    assert len([g for g in got if g[0] == 11]) == 400


def test_all_templates_side_by_side(frame):
    texts = [text for _, text in TEMPLATES]
    rows = [(1, "\n\n".join(texts)), (2, "\n\n".join(texts[::-1])), (3, "\n".join(text for text in texts if len(text) < 130))]
    got = sorted((r["doc_id"], r["template"], r["missing_words"], r["added_words"]) for r in find_licenses(frame(rows)).collect())
    short = [number for number, text in enumerate(texts) if len(text) < 130]
    assert got == [(key, number, 0, 0) for key in (1, 2) for number in range(len(texts))] + [(3, number, 0, 0) for number in short]


def test_places_are_exact(frame):
    text = "é words before. Released under the MIT License. After"
    row = find_licenses(frame([(1, text)])).first()
    assert text[row["begin"] : row["end"]] == "Released under the MIT License"


def test_empty_table_columns_and_templates(frame):
    assert found(frame([])) == []
    df = frame([(1, "Released under the MIT License.", 5, "x")], "doc_id int, text string, begin int, license string")
    assert found(df) == [(1, "MIT", 0, 0)]
    assert found(frame([(1, "You must smile, says our licence.")]), templates=(("Smile", "You must smile, says our licence."),)) == [(1, "Smile", 0, 0)]
    with pytest.raises(ValueError):
        find_licenses(df, templates=(("None", "no word to find it by"),))


class Nothing:
    """A compressor to which all texts are alike."""

    def compress(self, body):
        return b"always as long"


def scanned(text, constant=False):
    ready, plain = prepare(TEMPLATES), licenses.zstandard.ZstdCompressor(level=licenses.LEVEL, write_content_size=False, write_checksum=False)
    if constant:
        plain = Nothing()
        for template in ready:
            template.compressor = plain
    reach = max(len(text) for _, text in TEMPLATES) * 5 // 4
    found = scan_text(text, ready, re.compile("(?i)" + "|".join(CUES)), plain, reach)
    return [(r["template"], r["begin"], r["end"], r["missing_words"], r["added_words"]) for r in found]


def by_wording_alone(text):
    """Every template against all words of the text, without cues, blocks or compression."""
    spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    places = [(t.number, *place) for t in prepare(TEMPLATES) for place in differences(t.words, words)]
    taken = []
    for place in sorted(places, key=lambda p: (-p[3], p[4] + p[5], p[1], p[0])):
        if all(place[2] <= other[1] or place[1] >= other[2] for other in taken):
            taken.append(place)
    return sorted(((n, spans[first][0], spans[last - 1][1], missing, added) for n, first, last, _, missing, added in taken), key=lambda r: r[1])


def test_rounds_of_compression_find_what_wording_alone_finds(prose):
    dice, count = random.Random(6), 0
    for _ in range(60):
        parts = []
        for _ in range(dice.randrange(1, 6)):
            words = dice.choice(TEMPLATES)[1].split()
            if len(words) > 12 and dice.random() < 0.5:
                words[dice.randrange(4, len(words) - 4)] = "otherwise"
            parts += [prose(dice.randrange(0, 60)), " ".join(words)]
        text = "\n".join(parts)
        assert scanned(text) == by_wording_alone(text)
        count += len(scanned(text))
    assert count > 100


def test_a_constant_compressor_finds_nothing():
    text = " and ".join(text for _, text in TEMPLATES)
    assert len(scanned(text)) == len(TEMPLATES) and scanned(text, constant=True) == []
