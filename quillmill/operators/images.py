"""Classes of images by what their pixels show: ruling lines, lines of text, strokes, colour. What is not sure is UNKNOWN.

A small helper decodes an image and measures it. Class models are means and spreads of the measures over labelled images, added up
by Spark; an image is of the class that explains its measures best, if it does so well enough and clearly better than the next one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("ink", "aspect", "rows_ruled", "columns_ruled", "text_lines", "line_height", "strokes", "colour")
#: Pixels that an image may have to be measured; larger ones are not decoded, as they are no part of a page.
MOST = 1 << 26
#: Fixed values of the PNG format: its signature, and the samples of a pixel by colour type.
_PNG, _SAMPLES = b"\x89PNG\r\n\x1a\n", {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def pixels(content: bytes) -> np.ndarray | None:
    """The pixels of a PNG image of 8 bits a sample, as red, green, blue on white; None for any other or a damaged one."""
    if content[:8] != _PNG or len(content) < 33:
        return None
    width, height = int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")
    depth, kind, interlaced = content[24], content[25], content[28]
    if depth != 8 or kind not in _SAMPLES or interlaced or not 0 < width * height <= MOST:
        return None
    at, data, palette = 8, [], None
    while at + 8 <= len(content):
        size, name = int.from_bytes(content[at : at + 4], "big"), content[at + 4 : at + 8]
        if name == b"IDAT":
            data.append(content[at + 8 : at + 8 + size])
        elif name == b"PLTE":
            palette = np.frombuffer(content[at + 8 : at + 8 + size], np.uint8).reshape(-1, 3)
        at += size + 12
    samples = _SAMPLES[kind]
    try:
        flat = np.frombuffer(zlib.decompressobj().decompress(b"".join(data), height * (width * samples + 1)), np.uint8).reshape(height, width * samples + 1)
    except (zlib.error, ValueError):
        return None
    if flat[:, 0].max() > 4 or kind == 3 and palette is None:
        return None
    rows = _unfiltered(flat, samples).reshape(height, width, samples)
    if kind == 3:
        return palette[np.minimum(rows[:, :, 0], len(palette) - 1)]
    colour = rows[:, :, :3] if samples >= 3 else np.repeat(rows[:, :, :1], 3, axis=2)
    if samples in (2, 4):
        solid = rows[:, :, -1:].astype(np.uint16)
        colour = ((colour * solid + 255 * (255 - solid)) // 255).astype(np.uint8)
    return colour


def _unfiltered(flat: np.ndarray, step: int) -> np.ndarray:
    """The rows with their filters taken back."""
    before, out = np.zeros(flat.shape[1] - 1, np.uint8), np.empty((len(flat), flat.shape[1] - 1), np.uint8)
    for i, row in enumerate(flat):
        kind, line = int(row[0]), row[1:].copy()
        if kind == 1:
            line = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            line = line + before
        elif kind:
            own, up = line.tolist(), before.tolist()
            for x in range(len(own)):
                left, corner = (own[x - step], up[x - step]) if x >= step else (0, 0)
                if kind == 3:
                    guess = (left + up[x]) // 2
                else:
                    far = [abs(up[x] - corner), abs(left - corner), abs(left + up[x] - 2 * corner)]
                    guess = (left, up[x], corner)[far.index(min(far))]
                own[x] = (own[x] + guess) & 255
            line = np.array(own, np.uint8)
        out[i] = before = line
    return out


def _runs(on: np.ndarray) -> np.ndarray:
    """The lengths of the runs of ones."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return edges[1::2] - edges[::2]


def _ruled(ink: np.ndarray) -> int:
    """How many ruling lines go along the rows: groups of rows of which most is one stroke."""
    long = np.array([_runs(row).max(initial=0) for row in ink]) > 0.6 * ink.shape[1]
    return len(_runs(long))


def measured(content: bytes | None) -> list[float] | None:
    """The measures of an image, in the order of MEASURES; None if it cannot be read or is blank."""
    image = None if content is None else pixels(bytes(content))
    if image is None:
        return None
    grey = image.astype(np.float64).mean(axis=2)
    ink = grey < min(200.0, (grey.max() + grey.min()) / 2 + 1)
    ys, xs = np.flatnonzero(ink.any(axis=1)), np.flatnonzero(ink.any(axis=0))
    if not len(ys) or grey.max() - grey.min() < 30:
        return None
    box = ink[ys[0] : ys[-1] + 1, xs[0] : xs[-1] + 1]
    spread = image.max(axis=2).astype(int) - image.min(axis=2)
    lines = _runs(box.mean(axis=1) > 0.01)
    strokes = np.mean([len(_runs(row)) for row in box if row.any()])
    return [float(box.mean()), float(np.log(box.shape[1] / box.shape[0])), float(min(_ruled(box), 12)), float(min(_ruled(box.T), 12)), float(min(len(lines), 30)), float(np.median(lines) / box.shape[0]), float(strokes / box.shape[1] * box.shape[0]), float((spread > 60).mean())]


def measures(content: Column) -> Column:
    @F.pandas_udf("array<double>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([measured(c) for c in batch], dtype=object)

    return udf(content)


def fit(labelled: DataFrame) -> DataFrame:
    """(image_class, measure, mean, spread) from labelled images (content, image_class). Images that cannot be read teach nothing."""
    each = labelled.select("image_class", F.posexplode(measures(F.col("content"))).alias("measure", "value"))
    sums = each.groupBy("image_class", "measure").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("own"))
    whole = each.groupBy("measure").agg(F.greatest(F.stddev_pop("value"), F.lit(1e-6)).alias("whole"))
    # few examples may agree by chance: a spread is not taken for less than a fifth of that of all classes
    return sums.join(whole, "measure").select("image_class", "measure", "mean", F.greatest("own", F.col("whole") / 5).alias("spread"))


def _ruled_class(m: np.ndarray) -> str:
    """Without class models: what ruling lines and lines of text alone tell."""
    if m[2] >= 3 and m[3] >= 3:
        return "TABLE_IMAGE"
    if m[2] == m[3] == 0 and m[4] >= 3 and m[5] < 0.3 and m[7] < 0.05:
        return "TEXT_IMAGE"
    return "UNKNOWN"


def classified(assets: DataFrame, models: DataFrame | None = None, clear: float = 3.0, far: float = 4.0) -> DataFrame:
    """assets (asset_id, content, ...) with image_class, one of the listed classes.

    With models (of fit) an image is of the class with the greatest likelihood of its measures. It is UNKNOWN if the next class is less than
    e^clear times less likely, if a measure is on average more than `far` spreads away, or if it cannot be read. Models are rows of classes and
    measures alone, so the driver holds them.
    """
    table = None
    if models is not None:
        rows = models.collect()
        names = sorted({r.image_class for r in rows})
        table = names, np.zeros((len(names), len(MEASURES))), np.ones((len(names), len(MEASURES)))
        for r in rows:
            table[1][names.index(r.image_class), r.measure], table[2][names.index(r.image_class), r.measure] = r.mean, r.spread

    def judged(m) -> str:
        if m is None:
            return "UNKNOWN"
        m = np.asarray(m, np.float64)
        if table is None:
            return _ruled_class(m)
        names, mean, spread = table
        off = ((m - mean) / spread) ** 2
        score = -0.5 * off.sum(axis=1) - np.log(spread).sum(axis=1)
        order = np.argsort(-score, kind="stable")
        sure = (len(names) == 1 or score[order[0]] - score[order[1]] >= clear) and off[order[0]].mean() <= far**2
        return names[order[0]] if sure else "UNKNOWN"

    @F.pandas_udf("string")
    def kind(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([judged(m) for m in batch], dtype=object)

    return assets.withColumn("image_class", kind(measures(F.col("content"))))
