import re

import pytest


@pytest.fixture(scope="session")
def words_of():
    def split(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
        return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    return split
