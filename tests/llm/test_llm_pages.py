"""Main text of pages of several templates, block by block, and pages that never end."""

import time

import pytest

from wakeline.llm.extraction import main_text

ENGLISH = [
    "The harbour was quiet when we came in, and the crew had been waiting for us since the morning.",
    "It is not the size of the boat that matters but the way in which it is kept by those on board.",
    "When the wind turned to the north they were already on their way back, as he had told them to be.",
]
RUSSIAN = [
    "Гавань была тихой, когда мы вошли, и команда ждала нас с самого утра, сидя на палубе и глядя в море.",
    "Ветер повернул на север, и лодки пошли домой; никто не говорил, все смотрели на берег. Дождь начался.",
]
FINNISH = [
    "Satama oli hiljainen, kun saavuimme, ja miehistö oli odottanut meitä aamusta asti. Meri oli tyyni.",
    "Tuuli kääntyi pohjoiseen, ja veneet lähtivät kotiin; kukaan ei puhunut, kaikki katsoivat rantaan päin.",
]
MENU = "".join(f'<li><a href="/{n}">Section {n}</a></li>' for n in range(6))


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


# Template: what stands around the text, and whether a heading is part of it.
TEMPLATES = {
    "plain": '<body><div class="top"><ul>{menu}</ul></div><div><h1>A day at sea</h1>{text}</div>'
    "<p>© 2024 Some Company. All rights reserved.</p></body>",
    "table": "<body><table><tr><td><ul>{menu}</ul></td><td><h1>A day at sea</h1>{text}</td></tr></table>"
    '<div class="footer">Imprint and contact</div></body>',
    "sections": '<body><nav>{menu}</nav><section id="content"><h1>A day at sea</h1>{text}</section>'
    '<aside><p>Subscribe to the letter that we send to our readers on every day of the week, for you.</p></aside>'
    "<footer><p>Copyright Some Company</p></footer></body>",
    "article": '<body><ul>{menu}</ul><article><h1>A day at sea</h1>{text}</article><div class="sidebar-left">'
    "<p>It is the one thing that you have to see when you are in the city with your family.</p></div></body>",
    "blog": '<body class="home"><div class="comments-enabled post"><h1>A day at sea</h1>{text}</div>'
    '<div class="comments-area"><p>This was the best thing that I have read about the sea in a year!</p></div></body>',
}


@pytest.mark.parametrize("template", TEMPLATES)
@pytest.mark.parametrize("texts", [ENGLISH, RUSSIAN, FINNISH])
def test_blocks_of_templates(template, texts):
    """Every block of the text and no other."""
    page = TEMPLATES[template].format(menu=MENU, text=paragraphs(texts))
    assert main_text(page).split("\n") == ["A day at sea", *texts]


@pytest.mark.parametrize(
    "element, name",
    [
        ("section", 'class="related-work"'),
        ("p", 'class="share-price"'),
        ("p", 'id="notice-period"'),
        ("div", 'class="ads-theory"'),
        ("div", 'class="menu-engineering"'),
        ("p", 'data-x="1 > 0" title=\'a>b\''),
    ],
)
def test_names_that_only_begin_like_a_dropped_part(element, name):
    page = f"<article><p>{ENGLISH[0]}</p><{element} {name}>{ENGLISH[1]}</{element}></article>"
    assert main_text(page) == "\n".join(ENGLISH[:2])


@pytest.mark.parametrize(
    "name",
    ["ads", "ad-slot", "share-buttons", "related-posts", "sidebar_2", "social-icons-list", "cookie", "cookies-banner", "comments-list"],
)
def test_names_of_dropped_parts(name):
    page = f'<article>{paragraphs(ENGLISH[:2])}<div class="x {name}"><p>{ENGLISH[2]}</p></div></article>'
    assert main_text(page) == "\n".join(ENGLISH[:2])


def test_code_between_paragraphs_and_inline_advert():
    code = "for x in range(10): print(x, y[x], z[x]) ; " * 8
    page = f"<body><p>{ENGLISH[0]}</p><pre>{code}</pre><p>{ENGLISH[1]}</p></body>"
    assert main_text(page) == "\n".join([ENGLISH[0], code.strip(), ENGLISH[1]])
    page = f'<article><p>{ENGLISH[0]} <span class="ad">Buy</span> {ENGLISH[1]}</p></article>'
    assert main_text(page) == f"{ENGLISH[0]} {ENGLISH[1]}"


def test_tags_as_a_parser_reads_them():
    said = ENGLISH[0]
    assert main_text(f'<article><p title="a"b">{said}</p></article>') == said
    assert main_text(f"<article><p title=it's>{said}</p><p>{ENGLISH[1]}</p></article>") == f"{said}\n{ENGLISH[1]}"
    assert main_text(f"<article><p>{said}</p><script>if (a < b) '</p>'</script><p>x</article") == f"{said}\nx"
    assert main_text(f"<article><p>{said} 3 < 4</p><style>p {{}}</style\n></article>") == f"{said} 3 < 4"
    assert main_text(f"<article><p>{said}</p><title>a</titles>b</title></article>") == said
    assert main_text(f"<article><p>{said}</p><b><p>one</b> two</p></article>").split("\n")[1:] == ["one two"]


@pytest.mark.parametrize(
    "page",
    [
        "<script " * 3000,
        "<div>" * 8000,
        "<b>x" * 20000,
        "<p><b>x" * 10000,
        '<a href="' * 20000,
        "</a " * 30000,
        "<!-- " * 30000,
        "<b><div>" + "<i>" * 10000 + "</b>" * 10000,
        "<a =" + " " * 100000,
        "<style>x</style " * 5000,
        "<title>x</titleq" * 10000,
        '<div class="' + "menu-" * 20000 + 'x">t',
        "&#" * 50000,
    ],
)
def test_pages_that_never_end_take_linear_time(page):
    """Twice the page, about twice the time; on any machine well below a quadratic scan."""
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 2
