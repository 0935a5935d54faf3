#: Null, empty, blank, very long, tied and repeated texts.
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "x" * 200_000), (5, "same words in two rows here"), (6, "same words in two rows here"),
       (7, "one"), (7, "one"), (None, "a text without an id, which is kept"), (8, "\x00 ﻿ é日本🙂 '''s"), (9, "word " * 30_000)]
