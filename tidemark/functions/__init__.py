"""Column builders."""

from tidemark.functions import french  # noqa: F401
