"""Pages written and labelled by hand after layouts that sites use, independently of the generator that the extractor learns from."""

#: (html, main blocks in order).
PAGES = [
    (
        """<!doctype html><html><head><title>How to prune roses - Garden Notes</title><meta name=description content="x"></head><body class="post-template single">
<header class="site-header"><a class="logo" href="/">Garden Notes</a><nav class="main-navigation"><ul class="menu"><li><a href="/">Home</a></li><li><a href="/tips">Tips</a></li><li><a href="/about">About us</a></li></ul></nav></header>
<main id="main"><article class="post hentry"><h1 class="entry-title">How to prune roses</h1>
<div class="entry-content"><p>Prune roses in late winter, when the buds begin to swell. Use clean and sharp shears, and cut just above a bud that faces outwards.</p>
<p>Remove dead wood first. Then take out branches that cross, so that air can move through the plant.</p><h2>After the cut</h2><p>Feed the plant with compost, and water it well during dry weeks.</p></div></article></main>
<aside class="widget-area sidebar"><section class="widget"><h2>Recent posts</h2><ul><li><a href="/1">Tulips in pots</a></li><li><a href="/2">When to sow peas</a></li></ul></section></aside>
<footer class="site-footer"><p>&copy; 2021 Garden Notes. All rights reserved.</p></footer></body></html>""",
        [
            "How to prune roses",
            "Prune roses in late winter, when the buds begin to swell. Use clean and sharp shears, and cut just above a bud that faces outwards.",
            "Remove dead wood first. Then take out branches that cross, so that air can move through the plant.",
            "After the cut",
            "Feed the plant with compost, and water it well during dry weeks.",
        ],
    ),
    (
        """<html><head><title>Bridge reopens after repairs | The Daily Post</title><script>window.dataLayer=[];</script></head><body>
<div id="cookie-consent" role="dialog"><p>We use cookies to improve your experience. By continuing you accept our policy.</p><button>Accept all</button></div>
<div class="topbar"><a href="/subscribe">Subscribe</a> <a href="/login">Sign in</a></div><nav><a href="/world">World</a><a href="/sport">Sport</a><a href="/arts">Arts</a></nav>
<article><header><h1>Bridge reopens after repairs</h1></header><p>The old bridge over the river was opened to traffic again on Monday, two months earlier than planned.</p>
<div class="advertisement"><p>Buy one, get one free this weekend only!</p></div>
<p>Engineers replaced forty steel beams and renewed the road surface. <a href="/budget">The work cost less than the council had feared</a>, a spokesperson said.</p>
<blockquote><p>We are glad that the town is whole again.</p></blockquote></article>
<section class="comments"><h3>3 comments</h3><div class="comment"><b>Rob</b><p>About time too, I have been driving round for weeks.</p></div></section>
<footer><ul><li><a href="/contact">Contact</a></li><li><a href="/privacy">Privacy</a></li></ul><p>&copy; The Daily Post</p></footer></body></html>""",
        [
            "Bridge reopens after repairs",
            "The old bridge over the river was opened to traffic again on Monday, two months earlier than planned.",
            "Engineers replaced forty steel beams and renewed the road surface. The work cost less than the council had feared, a spokesperson said.",
            "We are glad that the town is whole again.",
        ],
    ),
    (
        """<html><body><div class="navbar"><ul><li><a href="#">Docs</a></li><li><a href="#">API</a></li><li><a href="#">Community</a></li></ul></div>
<div class="breadcrumb"><a href="/">Docs</a> / <a href="/guide">Guide</a></div>
<div class="content"><h1>Installing the tool</h1><p>Download the archive for your system and unpack it into any folder.</p><ol><li>Open a terminal in that folder.</li><li>Run the setup script and wait until it ends.</li></ol>
<pre>./setup --prefix=/opt/tool</pre><p>The script writes a log file. Keep it in case something goes wrong.</p></div>
<div class="related"><h4>See also</h4><a href="/update">Updating</a> <a href="/remove">Removing</a></div><div class="footer">Last built by the docs team</div></body></html>""",
        [
            "Installing the tool", "Download the archive for your system and unpack it into any folder.", "Open a terminal in that folder.", "Run the setup script and wait until it ends.",
            "./setup --prefix=/opt/tool", "The script writes a log file. Keep it in case something goes wrong.",
        ],
    ),
    (
        """<!DOCTYPE html><html><head><title>Linsensuppe</title></head><body><header><div class="brand">Kochbuch</div><form role="search" action="/suche"><label>Suche</label><input name="q"><button>Los</button></form></header>
<main><h1>Linsensuppe</h1><p>Eine einfache Suppe für kalte Tage, die in einer halben Stunde fertig ist.</p><h2>Zutaten</h2><ul><li>200 g rote Linsen</li><li>eine Zwiebel und zwei Möhren</li></ul>
<h2>Zubereitung</h2><p>Die Zwiebel fein würfeln und in Öl anschwitzen. Möhren und Linsen dazugeben, mit Wasser bedecken und zwanzig Minuten kochen.</p></main>
<div class="newsletter"><p>Jede Woche ein neues Rezept: Melden Sie sich für unseren Brief an.</p><button>Anmelden</button></div><footer><p>Impressum &middot; Datenschutz</p></footer></body></html>""",
        [
            "Linsensuppe", "Eine einfache Suppe für kalte Tage, die in einer halben Stunde fertig ist.", "Zutaten", "200 g rote Linsen", "eine Zwiebel und zwei Möhren", "Zubereitung",
            "Die Zwiebel fein würfeln und in Öl anschwitzen. Möhren und Linsen dazugeben, mit Wasser bedecken und zwanzig Minuten kochen.",
        ],
    ),
    (
        """<html><head><title>Night train to the coast</title></head><body><div id="wrap"><div id="top"><h2>Slow Travel</h2><p>Stories from the rails</p></div><div id="menu"><a href="/a">Stories</a> | <a href="/b">Maps</a> | <a href="/c">Contact</a></div>
<div id="post"><h1>Night train to the coast</h1><p>The carriage smelled of coffee and old leather. Outside, the fields lay grey under a thin moon, and nobody spoke.<br><br>At the border an officer looked at our papers, yawned, and wished us a good night.</p>
<p>We woke to the sound of gulls.</p></div><div class="share"><a href="#">Tweet</a> <a href="#">Share</a> <a href="#">Mail</a></div>
<div class="responses"><h3>Reader responses</h3><div class="reply"><p>Lovely piece, it took me right back to my student days.</p></div><div class="reply"><p>Which line was that, please?</p></div></div><div id="footer">Powered by hard work &copy; 2019</div></div></body></html>""",
        [
            "Night train to the coast",
            "The carriage smelled of coffee and old leather. Outside, the fields lay grey under a thin moon, and nobody spoke. At the border an officer looked at our papers, yawned, and wished us a good night.",
            "We woke to the sound of gulls.",
        ],
    ),
    (
        """<html><body><nav class=nav><ul><li><a href=/>Accueil<li><a href=/actu>Actualités<li><a href=/sport>Sport</ul></nav><div class="alert"><p>Ce site utilise des témoins de connexion.</p></div>
<article><h1>Le marché rouvre samedi</h1><p>Après trois semaines de travaux, le marché couvert accueillera de nouveau le public dès samedi matin.<p>Les commerçants promettent des prix stables jusqu'à la fin du mois, malgré la hausse du coût de l'énergie.
<table><tr><td>Ouverture</td><td>8 heures</td></tr></table></article><aside class=popular><h3>Les plus lus</h3><ol><li><a href=/1>Un hiver sans neige</a><li><a href=/2>La gare se modernise</a></ol></aside><footer>Mentions légales</footer></body></html>""",
        [
            "Le marché rouvre samedi", "Après trois semaines de travaux, le marché couvert accueillera de nouveau le public dès samedi matin.",
            "Les commerçants promettent des prix stables jusqu'à la fin du mois, malgré la hausse du coût de l'énergie.", "Ouverture", "8 heures",
        ],
    ),
]
