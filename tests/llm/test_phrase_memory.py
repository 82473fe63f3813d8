"""What a counting task holds at once."""

import pyarrow as pa

from holdfast.llm import phrases



def test_phrases_hold_few_texts_and_one_width_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 6_000), pa.array(["a b c d."] * 6_000)], ["lang", "text"])
    dealt = list(phrases._by_lang([batch]))
    assert sum(len(texts) for _, texts in dealt) == 6_000 and max(len(texts) for _, texts in dealt) <= phrases.BATCH_TEXTS
    grams = next(iter(phrases._grams(dealt[0][1], 4)))
    assert not isinstance(grams.widths, list)
    assert [(width, counts.tolist()) for width, _, _, counts, _ in grams.widths] == [
        (1, [2_500] * 4), (2, [2_500] * 3), (3, [2_500] * 2), (4, [2_500])
    ]
