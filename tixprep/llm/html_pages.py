"""A few hand-made pages with marked main parts: blocks inside an element with ``data-main`` are
content, except those inside a ``data-not``. They show the extractor page furniture that carries no
telling tag name; the words are neutral filler."""

_P = ["The river rose through the night, and by morning the lower fields were under water.",
      "Officials said the work would take three years, cost less than planned, and close one lane at a time.",
      "It was not the first attempt. Earlier crews had left notes, maps and a broken sledge behind them.",
      "Add the flour slowly, stir until smooth, and let the dough rest for an hour before you shape it."]


def _page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>"


_TEXT = "".join(f"<p>{p} {q}</p>" for p, q in zip(_P, _P[1:], strict=False))
_SHORT = f"<p>{_P[0]}</p><p>Yes.</p><p>{_P[1]}</p>"

LABELLED_PAGES = [_page(b) for b in (
    f"<div class='header'><a href='/'>Home</a> <a href='/a'>News</a></div><div id='menu'><ul><li><a href='/b'>Sport</a></li><li><a href='/c'>Food</a></li></ul></div>"
    f"<div data-main class='content'><h1>River rises</h1>{_TEXT}</div><div class='sidebar'><h3>Most read</h3><ul><li><a href='/d'>Old story</a></li></ul></div><div class='footer'><p>&copy; 2020 All rights reserved.</p></div>",
    f"<div class='cookie-notice'><p>We use cookies to improve this site.</p><button>Accept</button></div><nav><a href='/x'>One</a></nav><main data-main><h2>Work begins</h2>{_SHORT}"
    f"<div class='share' data-not><a href='/s'>Share</a></div></main><section class='comments'><h3>Comments</h3><div class='comment'><p>Great read, thank you for this!</p></div><div class='comment'><p>I do not agree with the second part at all, sorry.</p></div></section><footer><p>Contact us</p></footer>",
    f"<header><h1>The Daily</h1><p>All the news</p></header><article data-main><h1>Notes</h1>{_TEXT}<aside data-not><h4>Related</h4><p><a href='/r'>More on this</a></p></aside><p>{_P[3]}</p></article>"
    f"<aside><p>Subscribe to our newsletter today.</p><form><input name='e'><button>Go</button></form></aside><footer><p>Imprint</p></footer>",
    f"<div><div><a href='/'>Home</a> | <a href='/n'>New</a> | <a href='/o'>Old</a></div><div data-main>{_TEXT}<ul><li>flour, two cups</li><li>water, one cup</li></ul><p>{_P[3]}</p></div>"
    f"<div class='ad'>Buy now and save, only today.</div><div class='widget'><p>Weather: sunny</p></div></div>",
    f"<div class='advert'><p>{_P[1]}</p></div><div class='post'><div data-main class='entry-content'><p>{_P[2]}</p><blockquote><p>{_P[0]}</p></blockquote><p>{_P[3]}</p></div></div>"
    f"<div id='comments'><ol><li><p>{_P[0]}</p></li><li><p>First!</p></li></ol><form><p>Leave a reply</p><textarea></textarea></form></div>",
    f"<div class='notice banner'><p>This site will be closed on Sunday for repairs. We are sorry for any trouble.</p></div><nav><ul><li><a href='/1'>A</a></li><li><a href='/2'>B</a></li></ul></nav><!-- x --><div class='ad'>{_P[1]}</div>"
    f"<article data-main><h1>Dough</h1>{_SHORT}<table><tr><td>flour</td><td>two</td></tr></table></article><footer>&copy; a &middot; {_P[2]}</footer>",
    f"<div class='ad'>{_P[0]}</div><article data-main><h1>Short</h1><p>One line.</p></article><footer>x</footer>",
    f"<nav><a href='/1'>A</a></nav><article data-main><p>{_P[3]}</p><form data-not class='signup'><p>Sign up for our letter</p><input></form><section data-not class='reader-comments'><p>{_P[2]}</p></section></article><footer>{_P[0]}</footer>",
)]
