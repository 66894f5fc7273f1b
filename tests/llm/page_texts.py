#: Pages written by hand, not by the generator of layouts, with their main texts: (html, text).
PAGES = {

"blog":("""<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Baking bread - My blog</title><link rel="stylesheet" href="s.css"><script>window.x = 1 < 2;</script></head>
<body class="home single"><div id="page" class="site"><header id="masthead" class="site-header"><div class="site-branding"><p class="site-title"><a href="/">My blog</a></p></div><nav id="site-navigation" class="main-navigation"><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li><li><a href="/contact">Contact</a></li></ul></nav></header>
<div id="content" class="site-content"><main id="main"><article id="post-7" class="post entry"><header class="entry-header"><h1 class="entry-title">Baking bread at home</h1></header><div class="entry-content"><p>Good bread needs four things: flour, water, salt and time.</p><h2>The dough</h2><p>Mix everything in a <em>large</em> bowl, cover it, and let it rest overnight.</p><ul><li>500 g of flour</li><li>350 g of water</li></ul><blockquote><p>Patience is the best yeast.</p></blockquote><p>Bake it in a hot oven until the crust is dark.</p></div></article>
<section id="comments" class="comments-area"><h2>2 thoughts on bread</h2><ol class="comment-list"><li class="comment"><p>I tried this and it worked really well, thank you.</p></li><li class="comment"><p>Mine was too wet.</p></li></ol><form class="comment-form"><label>Name</label><input><button>Post</button></form></section></main>
<aside id="secondary" class="widget-area"><section class="widget"><h3>Recent posts</h3><ul><li><a href="/a">How to make jam</a></li><li><a href="/b">A walk in the hills</a></li></ul></section></aside></div><footer class="site-footer"><p>&copy; 2024 My blog. All rights reserved.</p></footer></div></body></html>""",
"Baking bread at home\nGood bread needs four things: flour, water, salt and time.\nThe dough\nMix everything in a large bowl, cover it, and let it rest overnight.\n500 g of flour\n350 g of water\nPatience is the best yeast.\nBake it in a hot oven until the crust is dark."),
"news":("""<html><head><title>News</title></head><body><div class="cookie-banner">We use cookies to improve your visit. <button>Accept</button></div><div class="top-bar"><a href="/">World</a> <a href="/s">Sport</a> <a href="/w">Weather</a></div>
<div class="article-body"><h1>River floods the old town</h1><p>Water rose by two metres during the night, officials said on Monday.</p><div class="ad-slot"><p>Advertisement: cheap boots for rainy days.</p></div><p>Schools in the district stay closed until the end of the week, and the main bridge was shut to traffic.</p><p>The mayor asked people to stay away from the banks.</p><div class="related-stories"><h3>Related</h3><ul><li><a href="/1">Dam report delayed</a></li><li><a href="/2">Storm warning lifted</a></li></ul></div><p>Rain is expected to ease by Thursday.</p></div><div class="newsletter-signup"><p>Get our morning briefing by mail.</p></div><div id="footer"><a href="/t">Terms</a> | <a href="/p">Privacy</a></div></body></html>""",
"River floods the old town\nWater rose by two metres during the night, officials said on Monday.\nSchools in the district stay closed until the end of the week, and the main bridge was shut to traffic.\nThe mayor asked people to stay away from the banks.\nRain is expected to ease by Thursday."),
"plain":("""<html><body><h1>On clouds</h1><p>Clouds are made of very small drops of water.</p><p>They form when moist air cools, and they carry rain over long distances.</p></body></html>""","On clouds\nClouds are made of very small drops of water.\nThey form when moist air cools, and they carry rain over long distances."),
"manual":("""<body><nav class="toc"><ul><li><a href="#1">Install</a></li><li><a href="#2">Use</a></li></ul></nav><main class="content"><h1>The manual</h1><h2 id="1">Install</h2><p>Run the installer and follow its steps.</p><pre>make
make install</pre><h2 id="2">Use</h2><p>Start it from the menu, then open a file.</p><table><tr><th>Key</th><th>Action</th></tr><tr><td>Ctrl+S</td><td>Save the file</td></tr></table></main><footer>Version 2.1 &middot; <a href="/l">Licence</a></footer></body>""",
"The manual\nInstall\nRun the installer and follow its steps.\nmake make install\nUse\nStart it from the menu, then open a file.\nKey\nAction\nCtrl+S\nSave the file"),
"recipe":("""<html><head><title>Soup</title><style>.x{}</style></head><body><header class="site-head"><a href="/">Kitchen notes</a><form action="/find"><input name="q"><button>Search</button></form></header><nav class="menu"><ul><li><a href="/soups">Soups</a></li><li><a href="/cakes">Cakes</a></li></ul></nav>
<main class="recipe"><h1>Leek soup</h1><p>A warm soup for a cold evening, ready in half an hour.</p><h2>Ingredients</h2><ul><li>Three leeks, cut into rings</li><li>Two potatoes, peeled and diced</li></ul><h2>Method</h2><ol><li>Fry the leeks in butter until they are soft.</li><li>Add the potatoes and a litre of stock, and simmer.</li></ol></main>
<div class="advert"><p>Sharp knives, half price today.</p></div><footer><p>Kitchen notes, all rights reserved.</p></footer></body></html>""",
"Leek soup\nA warm soup for a cold evening, ready in half an hour.\nIngredients\nThree leeks, cut into rings\nTwo potatoes, peeled and diced\nMethod\nFry the leeks in butter until they are soft.\nAdd the potatoes and a litre of stock, and simmer."),
"docs":("""<!doctype html><html><head><title>Guide</title></head><body><div class="navbar"><a href="/">Docs</a><a href="/api">API</a><a href="/faq">Help</a></div><div class="container"><div class="sidebar"><ul><li><a href="#1">Install</a></li><li><a href="#2">Configure</a></li><li><a href="#3">Run</a></li></ul></div>
<div class="content"><h1>Installing the tool</h1><p>The tool runs on every common system and needs no other program.</p><h2>Steps</h2><p>Unpack the archive and put the folder on the search path.</p><pre>tool --version</pre><p>If a version is printed, everything is in place.</p></div></div><div class="footer"><p>Made by volunteers.</p></div></body></html>""",
"Installing the tool\nThe tool runs on every common system and needs no other program.\nSteps\nUnpack the archive and put the folder on the search path.\ntool --version\nIf a version is printed, everything is in place."),
"notice":("""<body><div class="notice"><p>This site will be closed for maintenance on Sunday.</p></div><nav><a href="/">Start</a> <a href="/p">Papers</a></nav><article><h1>On the migration of eels</h1><p>Eels leave the rivers in autumn &mdash; nobody has seen where they spawn.</p><p>Larvae drift back over two years,
 carried by the current.</p></article><section class="comments"><h3>Comments</h3><div class="comment"><p>My uncle used to catch them by hand.</p></div></section><footer><p>Imprint</p></footer></body>""",
"On the migration of eels\nEels leave the rivers in autumn — nobody has seen where they spawn.\nLarvae drift back over two years, carried by the current."),
"german":("""<html lang="de"><body><header><p>Stadtblatt</p><nav><ul><li><a href="/a">Politik</a></li><li><a href="/b">Kultur</a></li><li><a href="/c">Sport</a></li></ul></nav></header><main><article><h1>Neue Br&uuml;cke er&ouml;ffnet</h1><p>Nach drei Jahren Bauzeit ist die Br&uuml;cke &uuml;ber den Fluss seit gestern offen.</p><p>Der Umweg von zw&ouml;lf Kilometern f&auml;llt damit weg.</p></article></main><aside class="sidebar"><h3>Meistgelesen</h3><ul><li><a href="/x">Wetter am Wochenende</a></li></ul></aside><footer><p>Impressum und Datenschutz</p></footer></body></html>""",
"Neue Brücke eröffnet\nNach drei Jahren Bauzeit ist die Brücke über den Fluss seit gestern offen.\nDer Umweg von zwölf Kilometern fällt damit weg."),
"review":("""<html><body><div id="header"><h2>Film pages</h2></div><div id="menu"><a href="/1">New</a> | <a href="/2">Classic</a></div><div id="main"><div class="post"><h1>A quiet film about noise</h1><p>The film begins in a workshop where nobody speaks for ten minutes.</p><p>It is long, but it <i>earns</i> its length with <a href="/s">one scene</a> at the end.</p></div></div><div id="ads"><p>Tickets from five euros.</p></div><div id="comments"><p>I fell asleep halfway, sorry.</p><form><textarea>Your comment</textarea></form></div><div id="footer"><p>Contact the editors.</p></div></body></html>""",
"A quiet film about noise\nThe film begins in a workshop where nobody speaks for ten minutes.\nIt is long, but it earns its length with one scene at the end."),
"unclosed":("""<html><body><nav><ul><li><a href=/>Home<li><a href=/n>News</ul></nav><article><h1>Snow closes the pass</h1><p>The road over the pass is closed from tonight until further notice.<p>Drivers are asked to take the tunnel, which is open to all cars.</article><footer><p>About this paper</footer>""",
"Snow closes the pass\nThe road over the pass is closed from tonight until further notice.\nDrivers are asked to take the tunnel, which is open to all cars."),
"table":("""<html><body><header><p>Harbour office</p></header><main><article><h1>Tides this week</h1><p>High water comes about fifty minutes later each day.</p><table><tr><th>Day</th><th>Hour</th></tr><tr><td>Monday</td><td>six</td></tr></table><p>Small boats should not leave at low water.</p></article></main><footer><p>Harbour office, open daily.</p></footer></body></html>""",
"Tides this week\nHigh water comes about fifty minutes later each day.\nDay\nHour\nMonday\nsix\nSmall boats should not leave at low water."),
"empty":("""<html><head><title>Nothing</title></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/a">All</a></li></ul></nav><footer><p>&copy; nobody</p></footer><script>var a = "<p>no</p>";</script></body></html>""", ""),
}
