"""README claims that must follow the code."""

import os
import re

from eddyline.plans import QUERIES

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")


def test_readme_query_count_and_names():
    text = open(README).read()
    n = int(re.search(r"(\d+) queries are registered", text).group(1))
    assert n == len(QUERIES)
    def base(q):                  # the README writes name(_6h, _compat, _stream)
        while True:
            b = re.sub(r"(_stream|_6h|_compat)$", "", q)
            if b == q:
                return b
            q = b
    missing = [q for q in QUERIES if base(q) not in text]
    assert missing == []
