"""Parameters given as text, and small files read on the driver."""

from __future__ import annotations

from collections.abc import Iterable


def parse_ratio(ratio: str, rows: int) -> tuple[float, float, float]:
    """`auto`, by the number of rows, or three numbers joined by colons, normalised."""
    if ratio == "auto":
        return (0.70, 0.20, 0.10) if rows >= 1000 else (0.80, 0.10, 0.10)
    numbers = [float(x) for x in ratio.split(":")]
    if len(numbers) != 3 or sum(numbers) <= 0:
        raise ValueError(f"three numbers are needed: {ratio}")
    train, val, test = (x / sum(numbers) for x in numbers)
    return train, val, test


def parse_class_map(text: str) -> dict[int, str]:
    """`0:smoke,1:fire`."""
    return {int(k): v for k, _, v in (pair.partition(":") for pair in text.split(","))}


def class_names(spec: dict) -> list[str]:
    """`names` of a dataset description: a list, or a mapping in the order of its numbers."""
    names = spec["names"]
    return [str(names[k]) for k in sorted(names, key=int)] if isinstance(names, dict) else [str(n) for n in names]


def read_class_names(lines: Iterable[str]) -> list[str]:
    import yaml

    return class_names(yaml.safe_load("\n".join(lines)))


def require_classes(found: Iterable[str], required: Iterable[str]) -> None:
    """Raise if a required class is not found; both are normalised names."""
    if missing := sorted(set(required) - set(found)):
        raise ValueError(f"classes are missing: {', '.join(missing)}")
