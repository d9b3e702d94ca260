"""Synthetic pages with known main text, for training the block labeller: layouts, not language, are what they vary."""

from __future__ import annotations

from random import Random

SYLLABLES = ("th er on an re he in ed nd ha at en es or ti ou ing tion ble ly", "en er ch ei un ge ie st sch ver lich heit ung keit be au", "es en ou le qu ai ent re eau tre oi aux ment an eux la", "os de ci as que ra do el mente ado rr ll an co ez ga", "ka to mi ra no su ri ha ko te ne shi", "pra vo na ko sti ova ni ho je dla cze")
#: Phrases that surround main text, in several languages.
CHROME = {
    "nav": "Home|About|About us|Contact|News|Blog|Products|Services|Login|Sign in|Register|Search|Menu|Shop|Help|FAQ|Archive|Start|Über uns|Kontakt|Anmelden|Accueil|Contactez-nous|Connexion|Inicio|Contacto|Acceder|Sports|World|Business|Technology|Careers".split("|"),
    "footer": "© 2024 All rights reserved|Copyright 2023|Privacy Policy|Terms of Service|Imprint|Impressum|Datenschutz|Mentions légales|Política de privacidad|Powered by|Alle Rechte vorbehalten|Tous droits réservés|Todos los derechos reservados|Cookie settings|Sitemap|Follow us".split("|"),
    "notice": "We use cookies to improve your experience|By continuing you accept our use of cookies|Accept all|Diese Website verwendet Cookies|Nous utilisons des cookies|Usamos cookies|Please enable JavaScript|Your browser is out of date|Subscribe now to continue reading|You have 2 free articles left|Notice|Important notice|Site maintenance on Sunday".split("|"),
    "ad": "Advertisement|Sponsored|Anzeige|Publicité|Publicidad|Buy now|50% off today only|Limited offer|Click here|Learn more|Shop now|Save big".split("|"),
    "form": "Subscribe to our newsletter|Your email|Email address|Name|Submit|Send|Sign up|Password|Search|Leave a comment|Post comment|Message|Senden|Envoyer|Enviar|Remember me".split("|"),
    "side": "Popular posts|Most read|Recent articles|Trending|Categories|Tags|Archives|Related articles|You may also like|More from this author|Meistgelesen|Les plus lus|Lo más leído|Follow us|Recommended".split("|"),
    "comments": "Comments|3 comments|Reply|Report|Like|2 hours ago|Posted by|says:|Kommentare|Antworten|Commentaires|Répondre|Comentarios|Responder|Anonymous|January 5, 2024 at 10:12|Log in to reply|Guest wrote".split("|"),
}
#: Lines of their own kind that stand in main texts, as those of licences, code, addresses and captions: not prose, but not chrome.
ODD = ("Licensed under CC BY 4.0.", "This work is licensed under a public license, version 3.", "if x == 0: return None", 'name = "value-17"', "Contact: anna@example.org, +1 555 0100", "Tel. 030 123456", "Figure 1.", "Note:", "Copyright notice kept by the author.", "See also the next part.", "1.", "http://example.org/a/b?c=1")
#: Share of pages that are nested deeper, and by how many plain elements at most.
DEEP, DEEPER = 0.1, 40
#: Share of sections beside the main text that are not shown. Parts of the main text may be hidden too: they are text nonetheless.
UNSEEN = 0.04
NAMES = {
    "nav": "nav navbar menu main-menu site-nav navigation top-nav topbar breadcrumb breadcrumbs pagination pager submenu toc-nav skip-links".split(),
    "header": "header site-header masthead page-header top branding banner logo".split(),
    "footer": "footer site-footer page-footer bottom colophon copyright legal".split(),
    "ad": "ad ads advert advertisement ad-slot sponsored sponsor promo banner-ad adsense commercial ad-container dfp".split(),
    "notice": "notice cookie cookie-banner cookie-notice gdpr consent alert announcement paywall modal popup overlay message-bar warning".split(),
    "form": "form newsletter subscribe signup search-form login contact-form subscription newsletter-signup search".split(),
    "side": "sidebar side aside widget widgets widget-area rail right-column left-column related related-posts recommended popular trending tags tag-cloud share social social-links share-buttons author-box teaser more-stories".split(),
    "comments": "comments comment comment-list commentlist comment-section respond replies discussion disqus responses user-comments comment-body".split(),
    "main": "content main main-content article post entry entry-content post-content article-body article-content story story-body body-text text page-content blog-post single post-body prose hentry".split(),
    "none": "row col col-md-8 container wrapper inner box x1 css-1a2b3c section block group grid flex w-full layout page-wrap outer clearfix".split(),
}
#: Different words of a page, some of them alike.
POOL = 400
MARK = "\ue000"
KINDS = ("nav", "footer", "notice", "ad", "form", "side", "comments")


class PageMaker:
    """Pages whose main blocks begin with MARK."""

    def __init__(self, seed: int):
        self.r = Random(seed)

    def spoken(self) -> list[str]:
        """A page's words, of which its texts are made."""
        syllables = self.r.choice(SYLLABLES).split()
        return ["".join(self.r.choices(syllables, k=n)) for n in self.r.choices((1, 1, 2, 2, 3, 4), k=POOL)]

    def word(self) -> str:
        return self.r.choice(self.pool)

    def words(self, n: int) -> str:
        out = " ".join(self.r.choices(self.pool, k=n)).capitalize()
        return out + self.r.choice((".", ".", ".", "", "!", ",", " &amp;")) if n > 3 else out

    def passage(self, n: int) -> str:
        out, x = [], self.r.random()
        if x < 0.04:
            return self.r.choice(ODD)
        if x < 0.16:  # lines of lists, capitals, signs or repeated words are text as well
            mark = self.r.choice(("{} |", "{}!!", "{}***", "{}&amp;&amp;", "{}$$$", "{} {}", "{} {} {}", "- {}", "{}%%%"))
            return " ".join(mark.format(*[w] * 3).upper() if mark == "{}!!" else mark.format(*[w] * 3) for w in (self.word() for _ in range(n)))
        while n > 0:
            k = min(n, self.r.randint(1, 22))
            out.append(self.words(k).rstrip(".") + ".")
            n -= k
        return " ".join(out)

    def names(self, kind: str) -> str:
        if self.bare or self.r.random() < 0.15:
            return f' class="{self.r.choice(NAMES["none"])}"' if self.r.random() < 0.6 else ""
        of = self.r.choice(NAMES[kind])
        extra = f" {self.r.choice(NAMES['none'])}" if self.r.random() < 0.3 else ""
        return f' {self.r.choice(("class", "class", "id"))}="{of}{extra}"'

    def links(self, n: int, most: int = 3) -> str:
        said = [self.r.choice(CHROME["nav"]) if self.r.random() < 0.3 else self.words(self.r.randint(1, most)) for _ in range(n)]
        if self.r.random() < 0.75:
            return "<ul>" + "".join(f'<li><a href="/{i}">{w}</a></li>' for i, w in enumerate(said)) + "</ul>"
        return self.r.choice((" ", " | ", "<br>")).join(f'<a href="/{i}">{w}</a>' for i, w in enumerate(said))

    def section(self, kind: str, inside: bool = False) -> str:
        """A section beside the main text; one inside it, or without a telling name, shows by its words what it is."""
        r, say = self.r, lambda k: r.choice(CHROME[k])
        tag = {"nav": "nav", "footer": "footer", "side": "aside", "form": "form", "comments": "section", "notice": "div", "ad": "div"}[kind]
        tag = tag if r.random() < 0.6 and not (self.bare and r.random() < 0.5) else r.choice(("div", "div", "section") if kind != "comments" else ("div", "ul", "ol", "section"))
        named = "" if tag in ("nav", "footer", "aside", "form") and r.random() < 0.5 else self.names(kind)
        told = tag in ("nav", "footer", "aside", "form") or any(f'"{n}' in named for n in NAMES[kind])
        if inside and not told:
            named, told = f' class="{r.choice(NAMES[kind])}"', True
        if kind == "nav":
            body = self.links(r.randint(3, 10))
        elif kind == "footer":
            body = r.choice((f"&copy; {self.words(2)} &middot; {self.words(r.randint(2, 30))}", f"<p>{say(kind)} {self.words(r.randint(1, 4))}</p>{self.links(r.randint(0, 5))}", f"{say(kind)}<p>{self.passage(r.randint(4, 30))}</p>", f"&copy; {self.passage(r.randint(2, 40))}"))
        elif kind == "notice":
            body = r.choice((f"<p>{say(kind)}. {self.passage(r.randint(0, 25))}</p><button>{say(kind)}</button>", say(kind), f"{self.passage(r.randint(3, 30))} <a href='#'>{self.words(1)}</a>", f"<p>{self.passage(r.randint(3, 40))}</p>"))
        elif kind == "ad":
            body = r.choice((say(kind), f"{say(kind)}<p>{self.passage(r.randint(2, 25))}</p>", self.passage(r.randint(2, 25)), f'<a href="/x">{self.words(r.randint(2, 9))}</a>', f"<p>{self.passage(r.randint(3, 40))}</p>"))
        elif kind == "form":
            body = r.choice((f"<label>{say(kind)}</label><input type=text><button>{say(kind)}</button>", f"<h3>{say(kind)}</h3><p>{self.passage(r.randint(2, 20))}</p><input><button>{say(kind)}</button>", f"<p>{self.passage(r.randint(2, 25))}</p><label>{self.words(2)}</label><select><option>{self.words(1)}<option>{self.words(1)}</select>"))
        elif kind == "side":
            head = f"<h{r.choice('234')}>{say(kind) if r.random() < 0.6 else self.words(2)}</h3>" if r.random() < 0.7 else ""
            body = head + r.choice((self.links(r.randint(2, 8), 8), "".join(f"<div><a href='/'>{self.words(r.randint(2, 8))}</a><p>{self.passage(r.randint(3, 20))}</p></div>" for _ in range(r.randint(1, 4))), f"<p>{self.passage(r.randint(4, 35))}</p>", "".join(f"<p>{self.passage(r.randint(3, 20))}</p>" for _ in range(r.randint(1, 3)))))
        else:
            of = r.choice(("div", "div", "li", "article" if told else "li"))
            one = lambda: f"<{of}{self.names(kind)}><b>{self.words(r.randint(1, 2))}</b> {say(kind)}<p>{self.passage(r.randint(2, 40))}</p>{'<a href=#>' + say(kind) + '</a>' if r.random() < 0.5 else ''}</{of}>"
            plain = lambda: f"<{'li' if r.random() < 0.4 else 'p'}>{self.passage(r.randint(2, 40))}"
            body = (f"<h3>{say(kind)}</h3>" if r.random() < 0.7 else "") + "".join((one if r.random() < 0.6 else plain)() for _ in range(r.randint(1, 6)))
            named = named or self.names(kind)
        if not told and not any(w in body for w in CHROME[kind]):
            cue = r.choice(("b", "h4", "p", "span", "div"))
            body = f"<{cue}>{say(kind)}</{cue}>{body}"
        unseen = r.choice((" hidden", ' style="display:none"', ' aria-hidden="true"')) if r.random() < UNSEEN else ""
        body = f"<noscript>{body}</noscript>" if kind in ("notice", "ad") and r.random() < 0.1 else body
        return f"<{tag}{named}{unseen}>{body}</{tag}>"

    def deeper(self, html: str) -> str:
        """The part within plain elements."""
        if self.r.random() >= DEEP:
            return html
        name = f' class="{self.r.choice(NAMES["none"])}"' if self.r.random() < 0.6 else ""
        n, tag = self.r.randint(1, DEEPER), self.r.choice(("div", "div", "div", "section", "span"))
        return f"<{tag}{name}>" * n + html + f"</{tag}>" * n

    def article(self) -> str:
        r, html = self.r, []

        def keep(tag: str, inner: str, close: bool = True) -> None:
            unseen = " hidden" if r.random() < 0.01 else ""
            html.append(f"<{tag}{unseen}>{MARK}{inner}{f'</{tag}>' if close else ''}")

        if r.random() < 0.07:  # tiny ones
            keep(r.choice(("p", "p", "h1", "div")), self.passage(r.randint(1, 6)), r.random() < 0.8)
            return "".join(html)
        if r.random() < 0.85:
            keep(r.choice(("h1", "h1", "h2")), self.words(r.randint(2, 12)))
        short = r.random() < 0.2
        for i in range(r.choice((1, 1, 2, 3, 4, 6, 8, 10, 14, 20))):
            x = r.random()
            text = self.passage(r.randint(1, 2) if r.random() < 0.1 else r.randint(1, 8) if short or r.random() < 0.25 else r.randint(8, 120))
            if x < 0.7:
                keep(r.choice(("p", "p", "p", "div")), r.choice((text, text, f"<b>{text}<br>" if r.random() < 0.3 else text, text.replace(" ", ' <a href="/y">', 1) + "</a>" if text.count(" ") > 6 else text)), r.random() < 0.85)
            elif x < 0.78:
                keep(r.choice(("h2", "h3")), self.words(r.randint(1, 7)))
            elif x < 0.86:
                items = [self.passage(r.randint(2, 14)) for _ in range(r.randint(2, 5))]
                html.append("<ul>" + "".join(f"<li>{MARK}{t}" for t in items) + "</ul>")
            elif x < 0.92:
                keep(r.choice(("blockquote", "pre", "figcaption")), text)
            else:
                cells = [self.words(r.randint(1, 3)) for _ in range(4)]
                html.append("<table>" + "".join(f"<tr><td>{MARK}{a}<td>{MARK}{b}" for a, b in zip(cells[::2], cells[1::2], strict=True)) + "</table>")
            if i and r.random() < 0.12:
                html.append(self.section(r.choice(("ad", "ad", "notice", "side", "form")), True))
        if r.random() < 0.15:
            html.append(self.section(r.choice(("side", "comments", "form")), True))
        return "".join(html)

    def page(self) -> str:
        r = self.r
        self.pool = self.spoken()
        self.bare = r.random() < 0.2
        body = self.article()
        tag = r.choice(("article", "article", "main", "div", "div", "section"))
        if r.random() < 0.04:  # nothing but text
            return f"<html><body>{body}</body></html>"
        body = body if r.random() < 0.05 else f"<{tag}{'' if tag in ('article', 'main') and r.random() < 0.6 else self.names('main')}>{body}</{tag}>"
        if tag == "div" and r.random() < 0.4:
            body = f"<main>{body}</main>"
        body = self.deeper(body)
        before, after = [], []
        if r.random() < 0.6:
            before.append(f"<header{self.names('header') if r.random() < 0.5 else ''}>{self.words(r.randint(1, 3))}{f'<p>{self.words(r.randint(2, 9))}</p>' if r.random() < 0.5 else ''}{self.section('nav') if r.random() < 0.4 else ''}</header>")
        for kind, p, where in (("nav", 0.75, before), ("notice", 0.3, before), ("ad", 0.35, before), ("side", 0.2, before), ("form", 0.15, before), ("comments", 0.35, after), ("side", 0.4, after), ("form", 0.25, after), ("ad", 0.2, after), ("notice", 0.15, after), ("nav", 0.1, after)):
            if r.random() < p:
                where.append(self.section(kind))
        r.shuffle(before)
        r.shuffle(after)
        if r.random() < 0.85:
            after.append(self.section("footer"))
        if r.random() < 0.5:  # beside the article within the same wrappers
            k, n = r.randint(0, len(before)), r.randint(0, len(after))
            body = self.deeper("".join(before[k:]) + body + "".join(after[:n]))
            before, after = before[:k], after[n:]
        inner = self.deeper("".join(before) + body + "".join(after))
        if r.random() < 0.4:
            inner = f"<div class='{r.choice(NAMES['none'])}'>{inner}</div>"
        return f"<!doctype html><html><head><title>x</title></head><body>{inner}</body></html>"


def labelled_pages(n: int, seed: int) -> list[tuple[list, list[int]]]:
    """(blocks, whether each is of the main text) of n pages. Main blocks carry a mark that is taken away again."""
    from .html_blocks import blocks

    maker, out = PageMaker(seed), []
    for _ in range(n):
        found = blocks(maker.page())
        marks = [int(MARK in b.text) for b in found]
        kept = [(b._replace(text=text), m) for b, m in zip(found, marks, strict=True) if (text := b.text.replace(MARK, "").strip())]
        if kept:
            out.append(([b for b, _ in kept], [m for _, m in kept]))
    return out
