"""All registered queries of this subpackage."""

from reviewlake.llm import (  # noqa: F401 (they register)
    alignment,
    bpe,
    licenses,
    mixing,
    neardup,
    nearest,
    packing,
    phrases,
    products,
    suffixes,
    toxicity,
    tries,
    urls,
)
from reviewlake.llm.common import ORACLES, QUERIES  # noqa: F401
