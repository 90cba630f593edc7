"""Main text of web pages: flat text blocks, classified by a decision tree."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medlark.functions.types import col

# Kinds of elements in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SKIPPED = frozenset(
    "script style noscript template textarea title iframe object svg select button canvas audio video".split())
#: Elements, and whole tokens of class, id or role, that mark what surrounds an article.
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer footer form gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "pagination popup promo promoted promotion related search share sharing sidebar social sponsor "
    "sponsored subscribe toolbar widget".split())
#: Compound tokens; an underscore counts as a hyphen.
ASIDE_COMPOUNDS = frozenset(
    "ad-banner ad-container ad-slot ad-unit ad-wrapper breadcrumb-nav comment-form comment-list comments-area "
    "comments-list comments-section cookie-banner cookie-bar cookie-consent cookie-notice cookie-popup gdpr-banner "
    "gdpr-notice left-sidebar main-menu main-nav main-navigation nav-bar nav-menu newsletter-form newsletter-signup "
    "page-footer related-articles related-links related-news related-posts related-stories right-sidebar search-box "
    "search-form share-bar share-buttons share-links sidebar-left sidebar-right sidebar-widget site-footer site-header "
    "site-nav site-navigation skip-link social-buttons social-icons social-links social-media social-share "
    "sponsored-content widget-area cc-window disqus-thread".split())
MAIN_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose class, id and role speak of the page or of the text, not of what surrounds it.
UNMARKED = MAIN_TAGS | HEADINGS | {"html", "body"}

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "text_before", "text_after", "heading", "aside", "main")
#: A block of more words is running text, one with a greater share of words in links a list of links.
LONG, LINKED = 20, 1 / 3
#: Small labelled table, one block a row: the features in order, then 1 for text of the article.
#: Words of the block, share of words in links, the same for the blocks before and after, words of the
#: nearest running text before and after, whether it is a heading, inside an element that surrounds
#: articles, inside an article. Labels follow one rule: aside is none; in an article all is text but
#: lists of links; elsewhere running text is, and short blocks between, before or after it that are not
#: links, save for short last lines and for what stands alone before a title. The last rows were taken
#: from made-up and real sequences of blocks where a tree fitted to the others went against that rule.
LABELLED = """
1 1.0 0 0.0 1 1.0 0 0 0 1 0 0
2 1.0 1 1.0 1 1.0 0 0 0 1 0 0
1 1.0 1 1.0 8 0.0 0 0 0 1 0 0
3 1.0 2 1.0 14 0.0 0 0 0 1 0 0
9 0.0 1 1.0 10 0.0 0 0 0 1 0 0
18 0.0 1 1.0 10 0.0 0 0 0 1 0 0
42 0.0 60 0.0 12 0.0 60 0 0 1 0 0
25 0.0 80 0.0 0 0.0 80 0 0 1 0 0
16 0.1 120 0.0 0 0.0 120 0 0 1 0 0
70 0.0 40 0.0 30 0.0 40 30 0 1 0 0
30 0.0 70 0.0 45 0.0 70 45 0 1 0 0
5 0.0 90 0.0 30 0.0 90 30 1 1 0 0
12 0.2 60 0.0 40 0.0 60 40 0 1 1 0
33 0.0 55 0.0 20 0.0 55 0 0 1 1 0
4 1.0 30 0.0 6 1.0 30 0 0 1 1 0
60 0.0 30 0.0 50 0.0 30 50 0 1 1 0
1 1.0 0 0.0 2 1.0 0 0 0 0 0 0
2 1.0 1 1.0 2 1.0 0 0 0 0 0 0
4 1.0 3 1.0 12 0.0 0 0 0 0 0 0
6 0.5 2 1.0 3 1.0 0 0 0 0 0 0
3 0.0 2 1.0 2 1.0 0 0 0 0 0 0
5 0.0 70 0.0 4 1.0 70 0 0 0 0 0
8 0.0 1 1.0 5 0.0 0 0 0 0 0 0
7 0.8 60 0.0 0 0.0 60 0 0 0 0 0
9 0.0 4 1.0 0 0.0 0 0 0 0 0 0
12 0.6 3 1.0 9 0.5 0 0 0 0 0 0
2 1.0 5 0.0 3 1.0 0 0 1 0 0 0
3 0.0 2 1.0 4 1.0 0 0 1 0 0 0
4 0.0 3 0.0 2 0.0 0 0 0 0 0 0
2 0.0 1 0.0 3 0.0 0 0 0 0 0 0
6 0.0 4 0.0 0 0.0 0 0 0 0 0 0
9 1.0 30 0.0 40 0.0 30 40 0 0 0 0
14 0.9 3 1.0 2 1.0 0 0 0 0 0 0
24 0.0 1 1.0 50 0.0 0 50 0 0 0 1
46 0.0 8 0.0 70 0.0 0 70 0 0 0 1
90 0.0 60 0.0 40 0.0 60 40 0 0 0 1
31 0.1 44 0.0 25 0.0 44 25 0 0 0 1
150 0.0 10 0.0 3 1.0 0 0 0 0 0 1
22 0.0 35 0.0 2 1.0 35 0 0 0 0 1
6 0.0 2 1.0 40 0.0 0 40 1 0 0 1
9 0.0 60 0.0 50 0.0 60 50 1 0 0 1
10 0.0 18 0.0 60 0.0 0 60 1 0 1 1
2 0.0 18 0.0 40 0.0 0 40 1 0 1 1
5 0.0 30 0.0 20 0.0 30 0 1 0 1 1
60 0.0 10 0.0 45 0.0 0 45 0 0 1 1
14 0.0 60 0.0 50 0.0 60 50 0 0 1 1
3 0.0 45 0.0 30 0.0 45 30 0 0 1 1
1 0.0 40 0.0 9 0.0 40 0 0 0 1 1
2 0.0 5 0.0 20 0.0 0 0 0 0 1 1
38 0.3 50 0.0 12 0.0 50 0 0 0 1 1
12 0.6 30 0.0 30 0.0 30 30 0 0 1 1
4 1.0 60 0.0 55 0.0 60 55 0 0 1 1
200 0.0 10 0.0 20 0.0 0 0 0 0 1 1
18 0.0 12 0.0 9 0.0 0 0 0 0 1 1
3 0.0 4 0.0 2 0.0 0 0 0 0 1 1
1 0.0 2 0.0 0 0.0 0 0 0 0 1 1
6 0.0 9 0.0 0 0.0 0 0 0 0 1 1
5 0.0 3 0.0 1 1.0 0 0 0 0 1 1
2 1.0 6 0.0 3 1.0 0 0 0 0 1 1
8 0.5 2 1.0 4 0.0 0 0 0 0 1 1
11 0.0 7 0.0 6 0.0 0 0 0 0 1 1
4 0.0 1 1.0 2 0.0 0 0 1 0 1 1
1 1.0 4 1.0 5 0.5 0 0 0 0 1 1
7 0.0 50 0.0 14 0.1 50 0 0 0 1 1
100 0.0 100 0.0 100 0.0 100 100 0 0 0 1
200 0.0 80 0.0 60 0.0 80 60 0 0 0 1
45 0.0 150 0.0 90 0.0 150 90 0 0 0 1
70 0.1 70 0.0 120 0.1 70 120 0 0 0 1
30 0.0 90 0.0 75 0.0 90 75 0 0 0 1
80 0.4 90 0.1 70 0.2 90 70 0 0 0 1
85 0.0 130 0.0 9 0.3 130 0 0 0 0 1
66 0.0 75 0.0 4 1.0 75 0 0 0 0 1
120 0.0 6 0.0 100 0.0 0 100 0 0 0 1
40 0.0 120 0.0 0 0.0 120 0 0 0 0 1
35 0.1 5 0.0 6 0.0 60 80 0 0 0 1
6 0.0 90 0.0 80 0.0 90 80 0 0 0 1
12 0.0 45 0.0 110 0.0 45 110 0 0 0 1
3 0.0 70 0.0 60 0.0 70 60 0 0 0 1
18 0.0 100 0.1 95 0.0 100 95 0 0 0 1
2 0.0 120 0.0 25 0.0 120 25 0 0 0 1
10 0.2 80 0.0 40 0.0 80 40 0 0 0 1
5 0.0 60 0.0 7 0.0 60 90 0 0 0 1
7 0.0 5 0.0 8 0.0 60 90 0 0 0 1
3 0.0 3 0.0 2 0.0 55 70 0 0 0 1
1 0.0 2 0.0 1 0.0 40 30 0 0 0 1
4 0.0 8 0.0 50 0.0 110 50 0 0 0 1
14 0.0 12 0.0 15 0.0 24 65 0 0 0 1
9 0.0 30 1.0 40 0.0 35 40 0 0 0 1
4 0.0 75 0.0 90 0.0 75 90 1 0 0 1
5 0.0 110 0.0 3 0.0 110 60 1 0 0 1
7 0.0 3 1.0 5 0.0 0 80 1 0 0 1
6 0.0 0 0.0 95 0.0 0 95 1 0 0 1
5 0.0 8 0.0 100 0.0 0 100 0 0 0 1
7 0.0 6 0.0 4 0.0 0 85 0 0 0 1
11 0.0 2 1.0 90 0.0 0 90 0 0 0 1
15 0.0 80 0.0 8 0.2 80 0 0 0 0 1
14 0.0 60 0.0 0 0.0 60 0 0 0 0 1
17 0.0 9 0.0 3 1.0 70 0 0 0 0 1
3 0.0 0 0.0 6 0.0 0 90 0 0 0 0
4 0.0 2 1.0 7 0.0 0 70 0 0 0 0
7 0.0 80 0.0 0 0.0 80 0 0 0 0 0
9 0.1 75 0.0 5 0.4 75 0 0 0 0 0
3 0.0 45 0.0 2 1.0 45 0 0 0 0 0
6 0.2 9 0.0 0 0.0 100 0 0 0 0 0
2 0.0 90 0.0 3 1.0 90 0 1 0 0 0
12 0.0 3 1.0 0 0.0 0 0 0 0 0 0
16 0.0 2 1.0 4 1.0 0 0 0 0 0 0
5 1.0 80 0.0 70 0.0 80 70 0 0 0 0
3 1.0 60 0.0 3 1.0 60 0 0 0 0 0
12 0.8 100 0.0 90 0.0 100 90 0 0 0 0
26 0.9 40 0.0 60 0.0 40 60 0 0 0 0
30 1.0 25 1.0 28 1.0 0 0 0 0 0 0
60 0.0 100 0.0 120 0.0 100 120 0 1 0 0
25 0.0 90 0.0 80 0.0 90 80 0 1 0 0
40 0.1 150 0.0 70 0.0 150 70 0 1 0 0
8 0.0 80 0.0 90 0.0 80 90 0 1 0 0
6 0.0 100 0.0 90 0.0 100 90 1 1 0 0
90 0.0 60 0.0 65 0.0 60 65 0 1 0 0
3 0.0 45 0.0 55 0.0 45 55 0 1 0 0
5 0.0 4 0.0 6 0.0 70 80 0 1 0 0
12 0.0 90 0.0 85 0.0 90 85 0 1 1 0
45 0.0 100 0.0 120 0.0 100 120 0 1 1 0
5 0.0 80 0.0 60 0.0 80 60 1 1 1 0
3 1.0 2 1.0 4 1.0 0 0 0 0 1 0
5 1.0 4 1.0 6 1.0 0 0 0 0 1 0
2 0.9 3 1.0 2 1.0 0 0 0 0 1 0
8 1.0 7 1.0 9 0.9 0 0 0 0 1 0
4 1.0 3 1.0 40 0.0 0 40 0 0 1 0
6 1.0 5 1.0 0 0.0 0 0 0 0 1 0
5 1.0 6 0.9 70 0.0 0 70 0 0 1 0
3 1.0 45 0.0 4 1.0 45 0 0 0 1 0
7 1.0 80 0.0 6 1.0 80 0 0 0 1 0
6 1.0 90 0.0 40 0.0 90 40 0 0 1 1
30 0.7 60 0.0 45 0.1 60 45 0 0 1 1
60 0.0 4 1.0 5 1.0 0 0 0 0 1 1
8 0.0 5 1.0 70 0.0 0 70 0 0 1 1
37 0.4 22 0.0 143 0.4 22 0 0 0 0 0
125 0.1 17 0.0 12 0.5 0 0 0 0 1 1
85 0.4 85 0.4 12 0.9 0 0 0 0 0 1
15 0.0 8 0.6 3 0.9 0 0 0 0 0 0
1 0.5 10 0.0 98 0.0 107 98 0 0 0 0
127 0.4 16 1.0 11 0.2 0 0 0 0 0 1
22 0.5 159 0.2 17 0.5 159 0 0 0 0 0
35 0.4 35 0.4 112 0.2 0 112 0 0 0 0
1 0.0 8 0.6 8 0.1 0 0 1 0 0 0
12 0.6 13 0.6 16 0.0 0 0 0 0 1 1
91 0.4 0 0.0 91 0.4 0 0 0 0 0 1
14 0.5 1 0.2 120 0.4 66 0 0 0 1 1
19 0.5 20 0.5 18 0.5 0 0 0 0 1 1
3 0.0 4 0.0 12 0.0 156 0 0 0 0 0
4 0.0 68 0.2 11 1.0 68 0 0 0 0 0
32 0.0 5 0.0 182 0.0 0 182 0 0 1 1
12 0.0 155 0.0 20 0.0 155 34 0 0 1 1
4 0.0 23 0.0 171 0.0 23 171 0 0 1 1
159 0.3 5 0.0 193 0.3 24 193 0 0 1 1
1 0.0 8 0.0 12 0.0 42 0 0 0 1 1
155 0.4 123 0.0 155 0.4 123 0 0 0 0 1
38 0.2 12 0.1 18 0.0 159 35 0 0 0 1
62 0.0 156 0.0 53 0.0 156 53 0 0 1 1
153 0.4 125 0.2 153 0.4 125 0 0 0 1 1
9 0.9 9 0.9 20 0.0 0 0 1 0 1 1
4 0.3 177 0.1 121 0.0 177 121 1 0 1 1
4 0.0 2 0.0 103 0.3 164 103 0 0 1 1
110 0.0 270 0.0 22 0.0 270 22 0 0 1 1
1 1.0 12 1.0 1 1.0 0 0 1 0 1 0
1 0.1 3 0.0 21 0.0 161 21 0 0 1 1
2 0.0 2 0.0 12 0.0 0 0 0 0 1 1
10 0.0 4 0.0 12 0.0 0 236 1 0 1 1
29 0.4 29 0.4 29 0.4 0 0 0 0 0 0
27 0.0 2 0.0 13 0.0 23 103 0 0 1 1
16 0.2 4 0.5 16 0.8 0 0 0 0 0 0
22 0.0 80 0.2 1 0.1 80 0 0 0 0 1
24 0.1 8 0.5 1 0.5 0 0 0 0 0 1
30 0.2 30 0.2 64 0.0 30 0 0 0 0 1
4 0.0 1 0.0 132 0.2 0 132 0 0 0 1
1 0.6 3 0.6 2 0.6 0 0 1 0 1 0
4 0.0 3 1.0 14 0.0 0 68 1 0 1 1
47 0.4 47 0.4 47 0.4 0 0 0 0 0 1
2 0.0 7 0.9 3 0.0 0 35 0 0 1 1
5 0.6 14 0.1 7 0.1 0 0 0 0 1 1
15 0.0 14 0.0 11 1.0 0 0 0 0 0 1
50 0.4 8 0.5 113 0.0 0 113 0 0 0 1
15 0.5 20 0.5 143 0.0 0 143 0 0 1 1
5 0.0 1 0.9 5 0.0 0 65 1 0 1 1
12 0.1 76 0.4 16 0.1 0 78 0 0 0 0
16 0.0 4 0.5 17 0.0 0 0 0 0 0 1
34 0.4 12 0.8 26 0.0 0 26 0 0 0 0
1 0.0 63 0.0 1 1.0 63 0 1 0 1 1
21 0.2 7 0.5 17 0.0 0 0 0 0 0 1
1 0.0 5 0.0 11 0.8 23 0 1 0 1 1
1 1.0 102 0.05 1 1.0 102 0 0 0 1 0
147 0.1 6 0.0 12 0.0 0 60 0 0 0 1
31 0.2 1 0.0 8 0.0 0 106 0 0 0 1
102 0.2 1 1.0 17 0.1 0 23 0 0 0 1
4 0.9 1 0.9 11 0.5 0 0 0 0 1 1
6 0.6 13 0.9 5 0.6 0 0 0 0 1 0
135 0.2 135 0.4 7 0.2 0 115 0 0 0 1
57 0.0 68 0.4 10 0.0 0 72 0 0 0 1
145 0.0 116 0.3 17 0.3 116 112 0 0 1 1
1 0.0 13 0.5 2 0.0 0 61 0 0 0 0
1 0.3 1 0.3 179 0.0 0 179 0 0 1 1
13 0.5 50 0.0 130 0.2 50 130 0 0 1 1
3 0.3 90 0.3 7 0.0 90 0 0 0 1 1
136 0.0 162 0.1 13 0.0 162 0 0 0 1 1
3 1.0 1 1.0 55 0.4 0 0 0 0 1 0
5 0.0 3 0.0 7 0.0 0 0 0 0 0 0
22 0.2 9 0.9 14 0.8 0 0 0 0 0 1
21 0.1 15 1.0 9 0.0 0 0 0 0 0 1
40 0.4 40 0.4 40 0.4 0 0 0 0 0 0
9 0.0 13 0.0 6 0.1 0 0 0 0 0 1
15 0.0 18 0.0 16 0.0 81 37 0 0 0 1
23 0.1 19 0.1 22 0.1 94 22 0 0 0 1
33 0.1 2 0.0 33 0.1 72 33 0 0 0 1
34 0.2 34 0.2 34 0.2 34 34 0 0 0 1
2 0.8 8 0.8 5 0.8 0 0 0 0 1 0
12 0.8 10 0.8 11 1.0 0 0 0 0 1 0
5 0.0 113 0.0 9 0.5 113 0 0 0 1 1
9 0.0 84 0.05 122 0.4 84 0 1 0 1 1
25 0.0 25 0.0 45 0.4 25 0 0 0 0 1
22 0.0 140 0.2 16 0.9 140 0 0 0 1 1
14 0.0 4 0.6 11 0.0 0 21 0 0 0 0
37 0.0 37 0.0 122 0.4 37 0 0 0 0 1
24 0.0 8 0.0 141 0.4 101 0 0 0 0 1
67 0.0 67 0.0 139 0.4 67 0 0 0 0 1
11 1.0 15 0.0 10 1.0 0 0 0 0 1 1
12 0.6 13 0.6 43 0.1 0 43 1 0 1 0
43 0.4 69 0.0 7 1.0 69 0 0 0 0 1
41 0.4 41 0.4 41 0.4 0 0 0 0 0 1
43 0.4 4 0.6 9 0.0 0 35 0 0 0 1
1 0.0 8 1.0 79 0.1 0 79 0 0 0 1
15 0.2 20 0.2 18 0.2 0 0 0 0 0 1
6 1.0 8 1.0 106 0.2 0 106 0 0 1 0
3 0.0 131 0.1 21 0.05 131 21 0 0 0 1
14 0.1 8 0.1 111 0.1 0 111 1 0 0 1
4 0.2 6 1.0 1 0.2 35 82 1 0 0 1
34 0.4 34 0.4 0 0.0 0 0 0 0 0 0
37 0.2 121 0.2 9 0.6 121 0 0 0 0 1
31 0.4 133 0.1 31 0.4 133 0 0 0 0 0
8 0.0 155 0.1 10 0.0 155 0 0 0 0 0
15 0.5 102 0.0 10 0.0 102 0 0 0 0 0
70 0.05 3 1.0 15 0.0 0 53 0 0 0 1
23 0.0 0 0.0 13 0.5 0 0 0 0 0 1
137 0.0 0 0.0 15 0.0 0 158 0 0 0 1
1 1.0 1 1.0 1 0.0 0 0 0 0 1 1
11 0.0 4 0.1 13 0.6 0 0 1 0 0 0
123 0.2 0 0.0 11 0.8 0 0 0 0 0 1
139 0.2 0 0.0 13 0.5 0 0 0 0 0 1
82 0.05 5 0.6 0 0.0 0 0 0 0 0 1
15 0.0 6 0.9 17 0.2 0 23 0 0 0 0
15 0.1 64 0.4 10 0.6 0 0 0 0 0 0
13 0.5 11 0.5 141 0.4 0 0 0 0 0 0
9 0.0 5 0.0 9 0.1 0 0 0 0 0 1
4 0.5 4 0.5 9 0.6 0 0 0 0 1 1
10 0.5 1 1.0 80 0.2 0 80 0 0 1 1
4 0.5 96 0.0 13 0.9 96 0 0 0 1 1
3 0.2 130 0.0 1 0.2 0 152 0 0 0 1
5 0.5 9 0.5 3 0.8 0 0 0 0 1 1
15 0.1 0 0.0 17 0.1 0 21 0 0 0 0
10 1.0 12 0.0 63 0.05 0 63 0 0 1 1
8 0.5 41 0.0 0 0.0 41 0 0 0 0 0
14 0.5 16 0.5 15 0.5 0 0 0 0 0 0
1 0.0 5 0.0 135 0.4 36 0 0 0 0 0
9 0.0 5 0.0 33 0.4 0 0 0 0 0 0
14 0.1 12 0.1 9 0.8 0 0 0 0 0 1
13 0.1 14 0.1 11 0.1 0 69 0 0 0 1
34 0.1 12 0.6 8 0.2 0 31 0 0 0 1
40 0.4 133 0.1 115 0.1 133 115 0 0 0 0
27 0.2 72 0.4 9 0.1 0 85 0 0 0 1
8 0.1 13 0.1 6 0.0 149 0 1 0 0 0
12 0.0 10 0.0 10 0.0 50 0 0 0 0 1
18 0.1 7 0.6 16 0.1 0 147 0 0 0 0
1 0.9 9 0.5 1 0.9 0 0 0 0 1 1
21 0.5 49 0.4 2 1.0 99 0 0 0 1 1
21 0.5 127 0.05 2 1.0 127 0 0 0 1 1
12 0.5 11 1.0 7 0.8 0 0 1 0 1 1
13 0.1 0 0.0 14 0.1 0 0 0 0 0 1
1 0.9 75 0.2 5 0.9 75 0 0 0 1 0
21 0.2 110 0.4 16 0.2 0 70 0 0 0 1
21 0.0 15 0.8 68 0.1 0 68 0 0 0 1
21 0.0 1 0.5 76 0.05 0 76 0 0 0 1
11 0.0 11 0.0 8 0.0 23 0 0 0 0 0
8 0.0 33 0.2 11 0.1 33 0 0 0 0 0
135 0.0 1 1.0 17 0.1 0 134 0 0 0 1
63 0.2 11 1.0 16 0.0 0 156 0 0 0 1
159 0.05 13 0.8 16 0.2 0 137 0 0 0 1
11 0.0 13 0.0 11 0.0 0 0 0 0 0 1
9 0.2 111 0.1 7 0.2 111 0 0 0 0 0
15 0.2 14 0.2 22 0.5 89 0 0 0 0 1
15 0.0 9 1.0 19 0.0 0 0 0 0 0 1
5 0.0 12 0.8 8 0.0 0 0 0 0 0 0
18 0.0 0 0.0 12 1.0 0 0 0 0 0 0
1 0.0 3 0.0 4 0.0 0 84 1 0 0 1
9 0.0 7 0.0 0 0.0 21 0 0 0 0 0
11 0.1 6 1.0 25 0.2 0 25 0 0 0 1
15 0.1 67 0.0 1 1.0 67 0 0 0 0 1
23 0.0 0 0.0 19 0.0 0 21 0 0 0 1
23 0.0 23 0.0 0 0.0 23 0 0 0 0 1
88 0.05 147 0.0 0 0.0 147 0 0 0 0 1
16 0.0 2 0.6 16 0.0 0 0 0 0 0 1
32 0.4 4 0.9 32 0.4 0 0 0 0 0 0
38 0.0 12 0.8 16 0.6 0 0 0 0 0 1
37 0.4 37 0.4 18 0.0 0 0 0 0 0 0
26 0.2 13 1.0 10 1.0 0 0 0 0 0 1
10 0.0 15 0.0 6 0.5 0 0 0 0 0 1
11 0.0 114 0.0 16 0.0 114 0 0 0 0 0
6 0.0 1 0.0 5 0.0 130 150 0 0 0 1
20 0.0 0 0.0 18 0.0 0 57 0 0 0 0
102 0.1 0 0.0 78 0.0 0 78 0 0 0 1
26 0.0 0 0.0 90 0.1 0 90 0 0 0 1
66 0.05 0 0.0 66 0.05 0 66 0 0 0 1
15 0.0 9 1.0 7 0.0 0 0 0 0 0 0
10 1.0 69 0.4 159 0.05 0 159 0 0 1 1
58 0.1 0 0.0 16 0.0 0 103 0 0 0 1
39 0.0 0 0.0 10 1.0 0 99 0 0 0 1
37 0.0 0 0.0 10 0.0 0 27 0 0 0 1
8 1.0 29 0.0 8 1.0 29 0 0 0 1 0
9 0.5 10 0.1 4 1.0 0 0 0 0 0 0
19 0.0 3 0.0 10 0.0 0 0 0 0 0 1
13 0.1 156 0.1 9 0.1 156 0 0 0 0 1
9 0.1 15 0.1 13 0.1 0 138 0 0 0 1
13 0.6 1 1.0 22 0.2 0 22 1 0 1 0
13 0.1 149 0.1 8 0.1 149 0 1 0 0 0
15 1.0 6 0.0 14 0.0 0 0 0 0 1 1
1 1.0 4 1.0 1 1.0 0 0 0 0 1 0
13 0.0 8 0.6 12 0.0 0 21 0 0 0 0
13 0.2 13 1.0 9 0.0 0 0 0 0 0 1
14 0.0 0 0.0 13 1.0 0 0 0 0 0 0
9 0.0 6 1.0 15 0.0 0 123 1 0 0 1
18 0.0 151 0.0 93 0.4 151 0 0 0 0 1
5 0.0 10 0.8 5 0.0 0 155 0 0 0 0
6 1.0 47 0.05 96 0.2 47 96 0 0 1 1
10 0.0 12 0.9 7 0.2 0 21 0 0 0 0
14 1.0 68 0.0 13 1.0 68 0 0 0 1 0
14 0.0 4 1.0 9 0.0 0 73 0 0 0 0
19 0.2 14 0.5 13 0.0 0 0 0 0 0 1
"""

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
# A quotation begins right after an equals sign; elsewhere a quote is a character like others.
_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+|["'=/]""")
# States of an element: not aside, aside, an article inside an aside, a form, the header of an article.
_CLEAR, _ASIDE, _ANEW, _FORM, _LEAD = 0, 1, 2, 3, 4


@lru_cache(maxsize=64)
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\s*>", re.I)


@lru_cache(maxsize=4096)
def _marked(attributes: str) -> bool:
    """Whether a token of class, id or role is one of what surrounds articles."""
    seen: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        seen.setdefault(name.lower(), value)
    tokens = [t for k in ("class", "id", "role") for t in unescape(seen.get(k, "").strip("\"'")).lower().split()]
    return any(t in ASIDE_WORDS or t.replace("_", "-") in ASIDE_COMPOUNDS or _of_readers(t.replace("_", "-")) for t in tokens)


def _of_readers(token: str) -> bool:
    """``user-comment`` or ``wp-block-comments``, but not ``no-comments``, which speaks of the page."""
    first, *_, last = token.split("-") if "-" in token else ("", "")
    return last in ("comment", "comments") and first not in ("no", "has", "with", "without", "allow", "open", "closed")


def _state(name: str, attributes: str, outer: int, main: int) -> int:
    """The state of an element, given the element around. An article inside a marked one starts anew unless it is marked itself."""
    if name in MAIN_TAGS:
        return _ANEW if outer in (_ASIDE, _FORM) and not _marked(attributes) else outer
    if outer == _ASIDE or name not in UNMARKED and _marked(attributes):
        return _ASIDE
    if name == "form" and not main:
        return _FORM
    if name == "header" and main and outer != _FORM:
        return _LEAD if outer == _CLEAR else outer
    return _ASIDE if name in ASIDE_TAGS else outer


def _settled(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """What is aside after all, known once the page is read.

    Articles inside marked elements are text if they hold more words than those outside. A form is the page's layout,
    and judged like any other element, if there is more running text in forms than outside; else it is its fields. In
    the header of an article its headings and running text belong to it.
    """
    words, running = [0] * 5, [0] * 5
    for text, share, _, state, main in found:
        n = text.count(" ") + 1
        if main:
            words[state] += n
        if n > LONG and share <= LINKED:
            running[state] += n
    anew = _CLEAR if words[_ANEW] > words[_CLEAR] + words[_LEAD] else _ASIDE
    form = _CLEAR if running[_FORM] > running[_CLEAR] + running[_LEAD] + (running[_ANEW] if anew == _CLEAR else 0) else _ASIDE

    def settle(text: str, heading: int, state: int) -> int:
        if state == _LEAD:
            return _CLEAR if heading or text.count(" ") + 1 > LONG else _ASIDE
        return {_ANEW: anew, _FORM: form}.get(state, state)

    return [(text, share, heading, settle(text, heading, state), main) for text, share, heading, state, main in found]


def blocks(html: str) -> list[tuple[str, float, int, int, int]]:
    """The text blocks of a page in order: (text, share of words in links, heading, aside, main).

    A block ends where a block-level element starts or ends. Comments, scripts, styles, forms'
    fields and a tag cut off by the end of the page are skipped; a line break is white space.
    """
    found: list[tuple[str, float, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, int]] = []  # element, state (aside or not), inside a main part
    opened: Counter[str] = Counter()  # how many of each are on the stack
    headings = anchors = 0

    def close_block() -> None:
        if parts:
            words = "".join(parts).split()
            if words:
                aside, main = stack[-1][1:] if stack else (0, 0)
                heading = headings > 0
                share = min(1.0, len("".join(linked).split()) / len(words))
                found.append((" ".join(words), share, int(heading), aside, main))
        parts.clear()
        linked.clear()

    def leave() -> str:
        nonlocal headings
        gone = stack.pop()[0]
        opened[gone] -= 1
        headings -= gone in HEADINGS
        return gone

    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        text = html[at:] if lt < 0 else html[at:lt]
        if text:
            decoded = unescape(text)
            parts.append(decoded)
            if anchors:
                linked.append(decoded + " ")
        if lt < 0:
            break
        if html.startswith("<!--", lt):
            stop = html.find("-->", lt + 4)
            at = end if stop < 0 else stop + 3
            continue
        tag = _NAME.match(html, lt)
        if not tag:
            if html[lt + 1: lt + 2] in ("!", "?", "/"):
                stop = html.find(">", lt)
                at = end if stop < 0 else stop + 1
            else:
                parts.append("<")
                at = lt + 1
            continue
        rest = _REST.match(html, tag.end())
        at = rest.end() if rest else html.find(">", tag.end()) + 1 or end
        attributes = html[tag.end(): at - 1]
        name = tag[1].lower()
        if name in BLOCKS:
            close_block()
        if html[lt + 1] == "/":
            if opened[name]:
                while leave() != name:
                    pass
            if name == "a":
                anchors = max(0, anchors - 1)
            continue
        if name == "br":
            parts.append(" ")
        if name in SKIPPED:
            stop = _end_of(name).search(html, at)
            at = stop.end() if stop else end
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name == "a":
            anchors += 1
        if name in ("p", "li") and opened[name]:
            # An open paragraph or item ends where the next begins, unless an element holds the next.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    while len(stack) > i:
                        leave()
                    break
                if stack[i][0] in BLOCKS:
                    break
        aside, main = stack[-1][1:] if stack else (0, 0)
        stack.append((name, _state(name, attributes, aside, main), int(main or name in MAIN_TAGS)))
        opened[name] += 1
        headings += name in HEADINGS
    close_block()
    return _settled(found)


def _reached(words: np.ndarray, links: np.ndarray, aside: np.ndarray) -> np.ndarray:
    """For each block the words of the nearest running text before it, 0 if there is none.

    Between them stand short blocks only: links end the search, what is aside is passed over.
    """
    out, last = np.zeros(len(words)), 0.0
    for i, (n, share, out_of_flow) in enumerate(zip(words, links, aside)):
        out[i] = last
        if not out_of_flow and share > LINKED:
            last = 0.0
        elif not out_of_flow and n > LONG:
            last = n
    return out


def features(found: list[tuple[str, float, int, int, int]]) -> np.ndarray:
    """One row per block, as named in FEATURES."""
    words = np.array([b[0].count(" ") + 1 for b in found], float)
    links = np.array([b[1] for b in found], float)
    before, after = (lambda x: np.append(0, x[:-1])), (lambda x: np.append(x[1:], 0))
    flags = np.array([b[2:] for b in found], float).reshape(-1, 3)
    earlier = _reached(words, links, flags[:, 1])
    later = _reached(words[::-1], links[::-1], flags[::-1, 1])[::-1]
    return np.column_stack([words, links, before(words), before(links), after(words), after(links),
                            earlier, later, flags])


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1) -> tuple:
    """A decision tree by Gini impurity: (feature, threshold, left, right) or a leaf's (share,)."""
    if depth == 0 or len(set(y)) == 1 or len(y) < 2 * least:
        return (float(y.mean()),)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= t
            a, b = y[left], y[~left]
            if min(len(a), len(b)) < least:
                continue
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, t, left)
    if best is None:
        return (float(y.mean()),)
    _, f, t, left = best
    return (f, float(t), fit_tree(x[left], y[left], depth - 1, least), fit_tree(x[~left], y[~left], depth - 1, least))


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0] >= 0.5)
    f, t, left, right = tree
    out = np.empty(len(x), bool)
    low = x[:, f] <= t
    out[low], out[~low] = classify(left, x[low]), classify(right, x[~low])
    return out


@lru_cache(maxsize=1)
def trained_tree() -> tuple:
    table = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    return fit_tree(table[:, :-1], table[:, -1], depth=11)


def main_text(html: str | None) -> str:
    """The main text of one page, its blocks joined by a line feed; empty if there is none."""
    found = blocks(html or "")
    if not found:
        return ""
    keep = classify(trained_tree(), features(found))
    return "\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of the main text of every page.

    A null or empty page, or one without text, gives an empty text. Ids and addresses come back as they
    are, nulls and repeated rows too. Other columns are ignored. Pages are worked on one by one, so
    memory is bounded by the longest page.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, max(1, b.num_rows), 500):
                part = b.slice(at, 500)
                texts = [main_text(h.as_py()) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    own = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), col(html_col).cast("string").alias("html"))
    kinds = dict(own.dtypes)
    return own.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
