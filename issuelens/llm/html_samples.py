"""Small labelled pages: ``data-main`` opens what is the article, ``data-not`` what isn't although it is inside.

The texts are placeholders; only structure is learned from them.
"""

_LONG = "Word after word makes a sentence of some length, with a comma here and there, and it ends in a full stop. A second sentence follows the first one and says a little more about it than was known before."
_MORE = "Another paragraph of the text goes on with the matter at hand, names a few things, and leaves the reader with something to think about."
_LINKS = "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(6))
_PARAS = f"<p>{_LONG}</p><p>{_MORE}</p><h2>A heading</h2><p>{_LONG}</p><ul><li>{_MORE}</li><li>Short point.</li></ul><blockquote><p>{_MORE}</p></blockquote>"
_AD = "Buy now and save a lot, only today."


def _page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


LABELLED = [
    _page(f'<header class="site-header"><div class="logo">Name</div><nav><ul>{_LINKS}</ul></nav></header><main><article data-main><header><h1>Title of it</h1></header>{_PARAS}</article><aside class="sidebar"><h3>Popular</h3><ul>{_LINKS}</ul></aside></main><footer><p>Copyright, all rights reserved.</p></footer>'),
    _page(f'<div id="header"><h1>Site name</h1><p>What the site says about itself.</p></div><div id="menu"><ul>{_LINKS}</ul></div><div id="content" data-main><h1>Title of it</h1>{_PARAS}</div><div id="sidebar"><p>{_MORE}</p><ul>{_LINKS}</ul></div><div id="footer"><p>Legal words. <a href="/c">Contact</a></p></div>'),
    _page(f'<div class="cookie-notice"><p>This page keeps cookies, and by reading on you agree to that.</p></div><nav><a href="/">Home</a> <a href="/n">News</a></nav><article class="post" data-main><h1>Title of it</h1><p>{_LONG}</p><div class="ad" data-not>{_AD}</div><p>{_MORE}</p><p>{_LONG}</p></article><section id="comments"><h2>Comments</h2><div class="comment"><p>{_MORE}</p></div><div class="comment"><p>{_LONG}</p></div><form><label>Your name</label><p>Write a comment and send it to us.</p></form></section><footer>Name 2020</footer>'),
    _page(f'<div class="wrapper"><div class="topbar"><ul class="nav">{_LINKS}</ul></div><div class="banner ad"><p>{_AD}</p></div><div class="story" data-main><h1>Title of it</h1><div class="entry-content">{_PARAS}</div></div><div class="related"><h3>More like this</h3><ul>{_LINKS}</ul></div><div class="comments-area"><ol><li><p>{_LONG}</p></li><li><p>{_MORE}</p></li></ol></div></div><div class="footer"><p>Terms, privacy, imprint and so on.</p></div>'),
    _page(f'<header><h2>Name</h2></header><div class="container"><section class="main-content" data-main><h1>Title of it</h1><p>{_LONG}</p><p>{_MORE}</p><div class="newsletter" data-not><p>Sign up for our letter and get one mail a week.</p></div><p>{_LONG}</p><table><tr><td>Cell one</td><td>Cell two of it</td></tr></table></section><aside><div class="widget"><p>{_MORE}</p></div></aside></div><form class="search"><label>Search for a word</label></form><footer><div>Copyright</div></footer>'),
    _page(f'<div><div><ul>{_LINKS}</ul></div><div data-main><h1>Title of it</h1><p>{_LONG}</p><p>{_MORE}</p><p>{_LONG}</p></div><div><p><a href="/a">Imprint</a> <a href="/b">Privacy</a></p></div></div>'),
    _page(f'<nav><ul>{_LINKS}</ul></nav><div class="advert"><p>{_MORE}</p></div><main data-main><h1>Title of it</h1>{_PARAS}</main><section class="reader-comments"><article class="comment"><p>{_LONG}</p></article><article class="comment"><p>{_MORE}</p></article></section><div class="consent popup"><p>{_MORE}</p></div><footer><p>{_MORE}</p></footer>'),
    _page(f'<div class="alert notice"><p>{_MORE}</p></div><article data-main><h1>Title of it</h1><p>{_LONG}</p><aside class="promo" data-not><p>{_AD}</p></aside><p>{_MORE}</p><nav class="pagination" data-not><a href="/2">Next page</a></nav><form data-not><p>Tell us what you think of it.</p></form><footer data-not><p>Filed under things, by a writer.</p></footer></article><div id="disqus_thread"><p>{_LONG}</p></div><div class="side"><p>{_LONG}</p></div>'),
    _page(f'<article data-main><h1>Title of it</h1><p>{_LONG}</p><pre>code line here</pre><figure><figcaption>What is seen here.</figcaption></figure><p>{_MORE}</p><section class="comments" data-not><h3>Replies</h3><p>{_MORE}</p><p>{_LONG}</p></section></article><div class="sponsor"><p>{_AD}</p></div><footer>&copy; Name</footer>'),
    _page(f'<div class="ad">{_AD}</div><article data-main><h1>Title of it</h1><p>{_LONG}</p><p>{_MORE}</p><p>Short.</p></article><footer>&copy; Name &middot; {_MORE}</footer>'),
    _page(f'<form id="aspnetForm" method="post"><div id="top"><ul class="menu">{_LINKS}</ul></div><div id="content" data-main><h1>Title of it</h1>{_PARAS}</div><div class="search" data-not><label>Search for a word</label></div><div id="footer"><p>{_MORE}</p></div></form>'),
    _page(f'<form name="page"><div><ul>{_LINKS}</ul></div><div data-main><h1>Title of it</h1><p>{_LONG}</p><p>{_MORE}</p></div><div><p><a href="/a">Imprint</a></p></div></form><form class="login"><label>Your name</label><p>Log in to go on with it.</p></form>'),
    _page(f'<nav><ul>{_LINKS}</ul></nav><div class="review-body" data-main><h1>Title of it</h1><p>{_LONG}</p><p>{_MORE}</p><p>{_LONG}</p></div><div class="reviews"><div class="user-review"><p>{_LONG}</p></div><div class="user-review"><p>{_MORE}</p></div></div><div>Copyright 2020</div>'),
    _page(f'<div class="nav"><ul>{_LINKS}</ul></div><article class="post social thread-post" data-main><h1>Title of it</h1>{_PARAS}</article><div class="social-links"><ul>{_LINKS}</ul></div><div>&copy; Name, all rights reserved</div>'),
    _page(f'<header><nav><ul>{_LINKS}</ul></nav></header><article data-main><h1>Title of it</h1><p>{_LONG}</p><p>{_MORE}</p><h2>References</h2><ol>{_LINKS}</ol></article><footer><ul>{_LINKS}</ul></footer><p>Copyright Name</p>'),
    _page(f'<div id="menu"><ul>{_LINKS}</ul></div><main data-main><h1>Title of it</h1><p>{_LONG}</p><ul>{_LINKS}</ul><p>{_MORE}</p><h2>Sources</h2><ul class="sources">{_LINKS}</ul></main><div>All rights reserved.</div>'),
    _page(f'<div class="page"><div class="bar"><a href="/">Home</a> <a href="/x">More</a></div><div class="post-body" data-main><h1>Title of it</h1><p>{_LONG}</p><h2>References</h2><ol class="references">{_LINKS}</ol></div><div class="related" data-not><ul>{_LINKS}</ul></div><div>(c) 2021 Name</div></div>'),
]
