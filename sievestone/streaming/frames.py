"""From detections of a frame to the status of its workers, row by row, in batch and in streams alike."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..functions.scalars import ANCHORS, REQUIRED_ITEMS
from ..operators.compliance import LEAST_SCORE
from .gate import alerts

BOX = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>"
#: One row for each frame, as a detector gives it; workers in their order, with negative ids where no track is known.
FRAMES = f"frame_no BIGINT, workers ARRAY<STRUCT<track_id: BIGINT, box: {BOX}>>, items ARRAY<STRUCT<cls: STRING, box: {BOX}, conf: DOUBLE>>"


#: Pairs of an item and a worker's box that are scored at once.
CELLS = 1 << 17


def plain(boxes: pa.StructArray, at: np.ndarray) -> np.ndarray:
    """The corners of a box in each row; nulls are not numbers."""
    field = pc.struct_field(boxes, "box")
    return np.stack([pc.struct_field(field, c).to_numpy(zero_copy_only=False).astype(float)[at] for c in ("x1", "y1", "x2", "y2")], axis=1)


def worn_by(workers: np.ndarray, items: np.ndarray, cls: np.ndarray, conf: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of workers (boxes) and classes: who is best for an item (box, class, confidence), of equals the first.

    Scores are those of association_score(), in its order of operations. Of equal boxes only the first can be
    best, and equal items have one best, so both are taken once.
    """
    firsts = np.sort(np.unique(workers, axis=0, return_index=True)[1])
    w = workers[firsts]
    shapes = np.unique(np.column_stack([items, cls, conf]), axis=0)
    width, height = w[:, 2] - w[:, 0], w[:, 3] - w[:, 1]
    best, kinds = [], []
    step = max(1, CELLS // len(w))
    for low in range(0, len(shapes), step):
        x1, y1, x2, y2, c, confidence = shapes[low : low + step].T[:, :, None]
        k = c[:, 0].astype(int)
        x, y = (x1 + x2) * 0.5, (y1 + y2) * 0.5
        place, weight = (np.array(t)[k] for t in ([ANCHORS[n] for n in REQUIRED_ITEMS], [(0.15 if n == "gloves" else 0.30, 0.70 if n in ("helmet", "goggles") else 0.55) for n in REQUIRED_ITEMS]))
        inside = (x >= w[:, 0] - 0.2 * width) & (x <= w[:, 2] + 0.2 * width) & (y >= w[:, 1] - 0.2 * height) & (y <= w[:, 3] + 0.2 * height)
        across = (x - w[:, 0]) / np.fmax(width, 1.0) - place[:, :1]
        down = (y - w[:, 1]) / np.fmax(height, 1.0) - place[:, 1:]
        distance = np.sqrt(weight[:, :1] * across * across + weight[:, 1:] * down * down)
        near = np.maximum(0.0, 1 - np.fmin(distance / 0.75, 1.0))
        score = np.where(inside, 0.65, 0.0) + 0.35 * near + 0.05 * confidence
        top = score.argmax(axis=1)
        fits = score[np.arange(len(top)), top] >= least
        best.append(firsts[top[fits]])
        kinds.append(k[fits])
    return np.concatenate(best), np.concatenate(kinds)


def frame_statuses(frames: DataFrame, least: float = LEAST_SCORE, required: tuple[str, ...] = REQUIRED_ITEMS) -> DataFrame:
    """frame, track_id, missing for each worker; missing is null for a frame without a list of items. Nothing is grouped, so a stream needs no state for it."""
    number = {n: k for k, n in enumerate(REQUIRED_ITEMS)}
    # What lacks, by the set of what is worn.
    lists = pa.array([[n for n in dict.fromkeys(required) if n not in number or not mask >> number[n] & 1] for mask in range(1 << len(number))] + [None], pa.list_(pa.string()))

    def missing(workers, items):
        if items is None:
            return np.full(len(workers), len(lists) - 1)
        masks = np.zeros(len(workers), int)
        cls = pc.index_in(pc.struct_field(items, "cls").cast(pa.string()), pa.array(REQUIRED_ITEMS)).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(~np.isnan(cls.astype(float)))
        tracks = pc.struct_field(workers, "track_id")
        if len(known) and len(workers):
            conf = pc.struct_field(items, "conf").fill_null(0.0).to_numpy(zero_copy_only=False)[known]
            conf = np.where(np.isnan(conf), 1.0, np.clip(conf, 0.0, 1.0))
            best, kinds = worn_by(plain(workers, np.arange(len(workers))), plain(items, known), cls[known], conf, least)
            same = np.unique(tracks.fill_null(0).to_numpy(zero_copy_only=False), return_inverse=True)[1]
            tracked = np.asarray(tracks.is_valid())
            held = np.zeros(len(workers), int)
            real = tracked[best]
            np.bitwise_or.at(held, same[best[real]], 1 << kinds[real])
            masks = np.where(tracked, held[same], 0)
        return masks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                workers, items = (batch.column(c).slice(r, 1) for c in ("workers", "items"))
                if workers.null_count:
                    continue
                people = workers.flatten()
                masks = missing(people, None if items.null_count else items.flatten())
                yield pa.RecordBatch.from_pydict({"frame": pa.repeat(batch.column("frame_no")[r], len(people)), "track_id": pc.struct_field(people, "track_id"), "missing": lists.take(pa.array(masks))})

    kind = dict(frames.dtypes)["frame_no"]
    return frames.select("frame_no", "workers", "items").mapInArrow(run, f"frame {kind}, track_id bigint, missing array<string>")


def compliance_alerts(frames: DataFrame, confirm: int = 3, clear: int = 2, ttl_ms: int | None = None) -> DataFrame:
    """Events of a stream of frames: association, status, gate."""
    return alerts(frame_statuses(frames), confirm, clear, ttl_ms)
