"""The small labelled table that the block classifier learns from.

Invented pages; ``data-keep`` marks the blocks below an element as main text (1) or not (0). They show
marked-up articles, articles in plain containers, short and link-rich paragraphs inside articles, and
menus, headers, footers, sidebars, notices, adverts, forms and reader comments in and around them. Where
nothing marks the article, or a name holds text and link lists alike, words and links of a block and its neighbours
tell them apart.
"""

LONG = "The committee met again on Tuesday to look at the figures for the year, and after some hours it agreed on a plan that nobody had asked for but most could accept. "
MID = "A second reading is planned for the spring, if the members find the time. "
SHORT = "So it was."

#: Links of as many words as a paragraph, and a few words among them.
BAR = "<a href=1>Ten ways to plan a walk in the rain</a> <a href=2>Why the figures of the year may lie</a> <a href=3>What the committee said</a>"
LIST = "<a href=4>The old town from above and below</a> <a href=5>A letter to all the members of the club</a>"

PAGES = (
    f"""<body><nav data-keep=0><ul><li><a href=/>Home</a></li><li><a href=/n>News of the day</a></li></ul></nav>
    <div class=ad data-keep=0>Buy now. The best shoes of the season at half price for you.</div>
    <article data-keep=1><h1>Plan agreed</h1><p>{LONG}</p><p>{SHORT}</p><p>{LONG}{MID}</p></article>
    <footer data-keep=0>© example.com · All about plans. {MID}</footer></body>""",
    f"""<body><header data-keep=0><a href=/>The Daily</a> <p>News since 1899</p></header>
    <main data-keep=1><h2>Spring</h2><p>{MID}</p><p>{SHORT}</p><ul><li>First point</li><li>Second point</li></ul><p>{LONG}</p></main>
    <aside data-keep=0><h3>Most read</h3><ul><li><a href=1>Ten ways to plan</a></li><li><a href=2>Why figures lie</a></li></ul><p>{LONG}</p></aside>
    <div class="cookie-notice" data-keep=0><p>We use cookies to make this site better. {MID}</p><button>OK</button></div></body>""",
    f"""<body><div id=menu data-keep=0><a href=a>One</a> <a href=b>Two</a></div>
    <div class=content data-keep=1><p>{LONG}{LONG}</p><p>{LONG}</p><p>{MID}</p></div>
    <div id=comments data-keep=0><h3>Comments</h3><p>{LONG}</p><p>{MID}</p><p>First!</p></div>
    <div class=footer data-keep=0><p>Imprint</p></div></body>""",
    f"""<body><table><tr><td data-keep=0><a href=a>Start</a></td><td data-keep=0><a href=b>Archive</a></td></tr></table>
    <p data-keep=1>{LONG}{MID}</p><p data-keep=1>{LONG}</p><p data-keep=1>{LONG}<a href=x>Read the plan</a></p>
    <p data-keep=0><a href=c>Next page</a></p><p data-keep=0>Contact us</p></body>""",
    f"""<body><article data-keep=1><header><h1>Figures</h1></header><p>{LONG}</p><blockquote>{MID}</blockquote>
    <aside class=related data-keep=0><p>{MID}</p></aside><p><a href=1>The figures</a> <a href=2>The plan</a></p><p>{SHORT}</p>
    <form data-keep=0><p>Your mail address {MID}</p></form><section class="comments" data-keep=0><p>{LONG}</p><p>Agreed.</p></section>
    <footer data-keep=0>Filed under plans</footer></article></body>""",
    f"""<body><div class=sidebar data-keep=0><p>{LONG}</p><p>{MID}</p></div><div class=newsletter data-keep=0><p>{LONG}</p></div>
    <div id=main data-keep=1><h1>Again</h1><p>{SHORT}</p><p>{LONG}</p><table><tr><td>1901</td><td>12</td></tr></table><p>{MID}</p></div>
    <div class=banner data-keep=0><p>{MID}</p></div></body>""",
    f"""<body><p data-keep=0><a href=a>Home</a> <a href=b>Search the site</a></p><h1 data-keep=1>A short walk through the old town in the rain</h1>
    <p data-keep=1>{LONG}</p><p data-keep=1>{LONG}{LONG}</p><p data-keep=1>{MID}{LONG}</p>
    <p data-keep=0>Share</p><p data-keep=0><a href=c>Mail</a> <a href=d>Print this page</a></p><p data-keep=0>© The Daily</p></body>""",
    f"""<body><main data-keep=1><p>{MID}</p><div class=promo data-keep=0><p>{LONG}</p></div><p>{SHORT}</p>
    <p><a href=1>Part one of the plan</a></p><pre>a = 1</pre></main><div role=contentinfo data-keep=0><p>{LONG}</p></div></body>""",
    # Articles that are the whole page, of one block or of very little text.
    f"<body><article data-keep=1><h1>Plan</h1><p>{SHORT}</p></article></body>",
    f"<article data-keep=1><p>{LONG}</p></article>",
    "<body><article data-keep=1><p><a href=1>Read the plan</a></p><p>Soon</p><p><a href=2>Part two</a></p></article></body>",
    f"<body><div class=ad data-keep=0>{LONG}</div><main data-keep=1><p>Soon</p><p>Later</p><p><a href=1>Now</a></p></main></body>",
    f"<body><p data-keep=0>Log in</p><article data-keep=1><p>Yes</p><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul>"
    f"<p>{MID}</p><p>The end</p></article><p data-keep=0>Imprint</p></body>",
    # Pages without any mark-up for the article.
    f"<body><p data-keep=0>Start</p><p data-keep=0>Archive</p><p data-keep=1>{LONG}</p><p data-keep=1>{SHORT}</p><p data-keep=1>{LONG}</p></body>",
    f"<body><h1 data-keep=1>Walk</h1><p data-keep=1>{LONG}</p><p data-keep=1>{SHORT}</p><p data-keep=1>{MID}</p></body>",
    f"<p data-keep=1>{LONG}</p>",
    f"<body><div data-keep=0><a href=a>One</a><a href=b>Two</a></div><div data-keep=1>{LONG}<p>{MID}</p><p>{LONG}</p></div>"
    "<div data-keep=0><a href=c>Three</a> Four</div></body>",
    # Long bars of links without a name, words beside them, and short paragraphs beside long ones.
    f"<body><div data-keep=0>{BAR}</div><p data-keep=0>Most read this week</p><div data-keep=0>{LIST}</div>"
    f"<p data-keep=1>{LONG}</p><p data-keep=1>{SHORT}</p><p data-keep=1>{MID}</p><p data-keep=1>{SHORT}</p><p data-keep=1>{LONG}{MID}</p>"
    f"<div data-keep=0>{LIST}</div><p data-keep=0>More of this</p><div data-keep=0>{BAR}</div></body>",
    f"<body><div data-keep=0>{LIST}</div><p data-keep=0>Topics of the day</p><div data-keep=0>{BAR}</div><div data-keep=0>{LIST}</div>"
    f"<h2 data-keep=1>What was agreed on</h2><p data-keep=1>{MID}</p><p data-keep=1>{MID}</p><p data-keep=1>{SHORT}</p><p data-keep=1>{LONG}</p></body>",
    f"<body><div data-keep=0>{LIST}</div><p data-keep=1>{MID}</p><p data-keep=1>{LONG}</p><p data-keep=1>{MID}</p><div data-keep=0>{BAR}</div>"
    f"<p data-keep=0>See also</p><div data-keep=0>{LIST}</div><p data-keep=1>{LONG}</p><p data-keep=1>{MID}</p><div data-keep=0>{LIST}</div>"
    f"<p data-keep=0>Sections</p><div data-keep=0>{BAR}</div></body>",
    # Names that mislead: lists of links named like an article, and an article below a name about the page's layout.
    f"<body><div class=content><div data-keep=0>{BAR}</div><p data-keep=0>Also of interest</p><div data-keep=0>{LIST}</div>"
    f"<p data-keep=1>{LONG}</p><p data-keep=1>{SHORT}</p><p data-keep=1>{MID}</p></div></body>",
    f"<body><div id=main><ul><li data-keep=0>{LIST}</li><li data-keep=0>Archive</li><li data-keep=0>{BAR}</li></ul>"
    f"<p data-keep=1>{MID}</p><p data-keep=1>{SHORT}</p><p data-keep=1>{LONG}</p><div data-keep=0>{BAR}</div><p data-keep=0>Tags</p><div data-keep=0>{LIST}</div></div></body>",
    f"<body><div class='page has-sidebar'><div class='content no-sidebar' data-keep=1><p>{LONG}</p><p>{SHORT}</p><p>{LONG}</p></div>"
    f"<div class=sidebar data-keep=0><p>{LONG}</p><p>{MID}</p></div></div></body>",
    f"<body><form id=pageForm><article class='post share-prices-rise' data-keep=1><h1>Shares</h1><p>{LONG}</p><p>{BAR}</p><p>{SHORT}</p></article></form></body>",
)
