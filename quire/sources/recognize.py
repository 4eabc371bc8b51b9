"""Where recognition engines plug in: page-parallel, without a shuffle.

An engine is a function from page content to rows; layout detectors, recognisers and preprocessing
steps are such functions too. Engines that read letters aren't part of this package; ENGINES holds those that a
caller registers, with readers here for the results of the usual kinds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quire.functions.pixels import binarize, denoise, deskewed, grey, table_grids
from quire.functions.tables import grid_html
from quire.operators.layout import CONTAINED

#: Row of a recognised box: pos, category, x, y, w, h, text, html, n_rows, n_cols, rec_score, flags.
BOX_SCHEMA = "doc_id string, page int, pos int, category string, x int, y int, w int, h int, text string, html string, n_rows int, n_cols int, rec_score double, flags array<string>, stage string, message string"
Step = Callable[[bytes, dict], tuple[bytes, dict]]


class UnknownStep(KeyError):
    """A preprocessing step that isn't registered."""


def preprocess(content: bytes, geometry: dict, steps: Sequence[str], registry: Mapping[str, Step]) -> tuple[bytes, dict]:
    for name in steps:
        if name not in registry:
            raise UnknownStep(name)
        content, geometry = registry[name](content, geometry)
    return content, geometry


def recognize_pages(pages: DataFrame, detect: Callable[[bytes], list[dict]], recognize: Callable[[bytes, dict], dict], steps: Sequence[str] = (), registry: Mapping[str, Step] | None = None) -> DataFrame:
    """BOX_SCHEMA rows of pages (doc_id, page, content).

    A box whose recognition raises stays, without content and flagged recognize_failed. A page whose
    preprocessing or detection raises is one row with stage and message; the others go on.
    """
    columns = [c.split()[0] for c in BOX_SCHEMA.split(", ")]

    def one(doc_id: str, page: int, content: bytes) -> Iterator[dict]:
        own = dict.fromkeys(columns) | {"doc_id": doc_id, "page": page}
        stage = "preprocess"
        try:
            content, _ = preprocess(content, {}, steps, registry or {})
            stage = "layout"
            boxes = detect(content)
        except Exception as e:  # noqa: BLE001  the page keeps its identity whatever an engine raises
            yield own | {"stage": stage, "message": f"{type(e).__name__}: {e}"}
            return
        for pos, box in enumerate(boxes):
            try:
                yield own | {"pos": pos} | box | recognize(content, box)
            except Exception:  # noqa: BLE001
                yield own | {"pos": pos} | box | {"flags": ["recognize_failed"]}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for d, p, c in zip(batch.doc_id, batch.page, batch.content, strict=True) for r in one(d, int(p), c)]
            made = pd.DataFrame(rows, columns=columns)
            yield made.astype({c: "Int32" for c in ("page", "pos", "x", "y", "w", "h", "n_rows", "n_cols")} | {"rec_score": "float64"})

    return pages.select("doc_id", "page", "content").mapInPandas(run, BOX_SCHEMA)


class UnknownName(KeyError):
    """An engine or layout that isn't registered."""


#: Engines by the name that settings use: functions (image, langs) -> word rows (pos, text, confidence from 0 to 100, line_key, x, y, w, h).
ENGINES: dict[str, Callable] = {}


def register_engine(name: str, read: Callable) -> None:
    ENGINES[name] = read


def engine(name: str) -> Callable:
    if name not in ENGINES:
        raise UnknownName(f"engine {name!r} isn't registered; there are {', '.join(sorted(ENGINES)) or 'none'}")
    return ENGINES[name]


def words_of_table(rows: Mapping[str, Sequence]) -> list[dict]:
    """Words from an engine that reports columns text, conf, block_num, par_num, line_num, left, top, width and height; blank ones and those without confidence go."""
    out = []
    for k, (text, conf) in enumerate(zip(rows["text"], rows["conf"], strict=True)):
        if text.strip() and float(conf) >= 0:
            key = [int(rows[c][k]) for c in ("block_num", "par_num", "line_num")]
            out.append({"pos": k, "text": text, "confidence": float(conf), "line_key": key} | dict(zip("xywh", (int(rows[c][k]) for c in ("left", "top", "width", "height")), strict=True)))
    return out


def words_of_detections(detections: Sequence[tuple]) -> list[dict]:
    """Words from an engine that reports (polygon, text, confidence from 0 to 1); lines are tens of pixels, half to the even one."""
    out = []
    for k, (polygon, text, confidence) in enumerate(detections):
        xs, ys = zip(*polygon, strict=True)
        x, y = int(min(xs)), int(min(ys))
        out.append({"pos": k, "text": text, "confidence": confidence * 100, "line_key": [round(y / 10), x], "x": x, "y": y, "w": int(max(xs)) - x, "h": int(max(ys)) - y})
    return out


def detections_of_pages(result: Sequence) -> list[tuple]:
    """(polygon, text, confidence) from either shape of a page result: dicts with rec_polys, rec_texts and rec_scores, or lists of (polygon, (text, confidence))."""
    out = []
    for page in result or ():
        if isinstance(page, Mapping):
            out += list(zip(page["rec_polys"], page["rec_texts"], page["rec_scores"], strict=True))
        else:
            out += [(polygon, text, confidence) for polygon, (text, confidence) in page or ()]
    return out


def whole_page(image: np.ndarray, langs: Sequence[str]) -> list[dict]:
    """The layout `none`: one text box of the whole page."""
    h, w = image.shape[:2]
    return [{"category": "text", "x": 0, "y": 0, "w": w, "h": h}]


def word_blocks(image: np.ndarray, langs: Sequence[str]) -> list[dict]:
    """The layout `tesseract`: a text box around the words of each block that the engine reports, by block."""
    blocks: dict[int, list[dict]] = {}
    for word in engine("tesseract")(image, langs):
        blocks.setdefault(word["line_key"][0], []).append(word)
    out = []
    for _, words in sorted(blocks.items()):
        x, y = min(w["x"] for w in words), min(w["y"] for w in words)
        out.append({"category": "text", "x": x, "y": y, "w": max(w["x"] + w["w"] for w in words) - x, "h": max(w["y"] + w["h"] for w in words) - y})
    return out


LAYOUTS: dict[str, Callable] = {"none": whole_page, "tesseract": word_blocks}


def detect_boxes(image: np.ndarray, layout: str, langs: Sequence[str]) -> list[dict]:
    """Ruled tables, which are always looked for, then the boxes of a layout; a text box that lies in a table by CONTAINED of its area goes."""
    if layout not in LAYOUTS:
        raise UnknownName(f"layout {layout!r} isn't registered; there are {', '.join(sorted(LAYOUTS))}")
    tables = [{"category": "table", **dict(zip("xywh", t["box"], strict=True)), "n_rows": t["n_rows"], "n_cols": t["n_cols"], "cells": t["cells"]} for t in table_grids(image)]
    shared = lambda a, b, k, n: max(0, min(a[k] + a[n], b[k] + b[n]) - max(a[k], b[k]))
    inside = lambda b, t: shared(b, t, "x", "w") * shared(b, t, "y", "h") >= CONTAINED * b["w"] * b["h"] > 0
    return tables + [b for b in LAYOUTS[layout](image, langs) if not any(inside(b, t) for t in tables)]


def recognize_table(image: np.ndarray, box: Mapping, table: str, read_text: Callable[[np.ndarray], str]) -> dict:
    """The content of a table box: each cell's text, white space as single blanks, as HTML; with table `none` no content and a flag."""
    if table == "none":
        return {"flags": ["provider_disabled"]}
    cells = []
    for r0, c0, r1, c1, (x, y, w, h) in box["cells"]:
        cells.append((r0, c0, r1, c1, " ".join(read_text(image[y : y + h, x : x + w]).split())))
    return {"html": grid_html(cells), "n_rows": box["n_rows"], "n_cols": box["n_cols"], "cell_boxes": [c[4] for c in box["cells"]], "flags": []}


def _deskew_step(image: np.ndarray, geometry: dict) -> tuple[np.ndarray, dict]:
    made, angle, matrix = deskewed(image)
    return made, geometry | ({"deskew_angle": angle, "deskew_matrix": list(matrix)} if angle else {})


#: Steps on arrays; `orientation` needs an engine that tells which way up a page is, so a caller registers it.
STEPS: dict[str, Callable] = {"deskew": _deskew_step, **{name: (lambda f: lambda image, geometry: (f(image), geometry))(f) for name, f in (("denoise", denoise), ("grayscale", grey), ("binarize", binarize))}}
