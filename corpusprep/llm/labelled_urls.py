"""A small labelled table of URLs, written out as words: invented, as no given table labels any.

``BLOCKED`` has families of names, one family to a line: what sites of a kind call themselves, with the spellings that
they use. ``FINE`` has names of other sites, many of which share letters with the first kind. The rows are made of
them by a rule: names alone and with common parts around them, under the same paths, so that it is the host that tells
them apart; and paths that tell by themselves.
"""

from __future__ import annotations

BLOCKED = """
casino casinos kasino cazino casinobonus onlinecasino casinogames grandcasino casinowin
poker pokers pokerstar pokerroom pokerbonus onlinepoker pokie pokies pokiesfree
slots slotz slotgames megaslots slotsonline freeslots slotbonus
jackpot jackpots jackpotwin megajackpot jackpotslots
roulette roulettes rouletta liveroulette rouletteonline
bet bets betting sportsbet betonline sportsbetting livebetting bettingtips freebet
bookie bookies bookmaker bookmakers bookiesonline
gambling gamble gambler gamblers gamblingonline
lottery lotteries lotto lottowin lotterywin lottonumbers
bingo bingos bingobonus onlinebingo
blackjack blackjacks blackjackonline baccarat baccarats wager wagers wagering
porn porno pornos porntube freeporn pornvideo pornpics
xxx xxxvideo xxxtube xxxpics freexxx
sex sexcam sexcams sexchat livesex freesex sextube
nude nudes nudecams nudepics nudegirls
adult adults adultdating adultchat adultcams adultvideo
cams webcams camgirls livecams nudecam
escort escorts escortgirls escortservice
hookup hookups hookupnow datinghookup
erotic erotica erotik eroticchat
fetish fetishes hentai hentais milf milfs
viagra viagras vlagra buyviagra viagraonline genericviagra
cialis cialiss buycialis cialisonline genericcialis
kamagra kamagras levitra levitras
pills pill dietpills cheappills pillsonline
pharmacy pharmacies epharmacy onlinepharmacy pharmacyrx cheappharmacy
meds rxmeds cheapmeds medsonline
xanax xanaxx buyxanax tramadol tramadols steroid steroids anabolic anabolics
warez warezz warezcrack appz gamez
crack cracks cracked crackz cracksoft
keygen keygens keygenz serialkeygen
serialz serialkeys crackserial
torrent torrents torrentz torrentsite freetorrent
pirate pirated piratebay piratedgames
nulled nulledscripts nulledthemes
phishing phish phisher malware malwares spyware spywares adware adwares ransomware
spam spams spammer spammers spamlist
scam scams scammer scammers
payday paydays paydayloan paydayloans
loans quickloans cashloans fastloans easyloans
doubler doublers bitdoubler coindoubler moneydoubler
prize prizes claimprize winprize freeprize
winbig winnow winmoney bigwin freewin
giveaway giveaways freegift freegifts freebies
replica replicas replicawatch replicabags cheapreplica
rolex rolexx fakerolex rolexreplica counterfeit counterfeits
ads adserver adservers adtrack adsnet adsclick popads
tracker trackers tracking adtracker trackclick clicktrack
clicks clickads clickbank clickmoney paidclicks
popup popups popunder popunders
banner banners bannerads adbanner
backlink backlinks buybacklinks linkfarm linkfarms cheaplinks
essaymill essaymills cheapessay buyessay essayfarm
miracle miracles miraclecure miraclepills
cheap cheapest cheapbuy buycheap supercheap
bonus bonuses bonuscode freebonus
"""

FINE = """
news newspaper dailynews localnews encyclopedia software gardening university cooking museum library libraries bicycles travel travels
recipes weather weatherstation health healthcare science sciences history music musicians stories storytelling school schools archive archives
forum government council theatre theatres therapy therapist neighbours orchestra photos photography maps kitchen kitchens mountains rivers teachers
mathematics astronomy medicine medicines parenthood furniture letters translation grammar writing painting architecture tennis football hiking
fishing farming farmers adventure adventures windows cheese freedom seasons additions essex sussex middlesex cocktail cocktails analytics adobe
adapter address academy camera cameras cambridge camping campus betty alphabet between better beta slate pillow pillows pillar serialisation
cracker wintersport winter windmill wind advice advisor admission island loanwords escalator nutrition nudge pornic sextant sexton
track-and-field athletics trackway clinic clinics clipper popular population bandana backpack backstage linköping linguistics essays-in-history
mirror mirrors chapel chapels chess bonsai bonn boat boats bookshop books bookbinding booklovers pharmacology pharmacists mediterranean media
torrential toronto piracy-law pirouette spanish spain scandinavia scholar paydirt paper papers prizewinning-poets replication rolling giveon
double-bass doubles price-index clickers bankers banana lottie lotus bingley blackbird blackwater wagner wagon gamelan games-history polka police
pokhara kasimir casing casa jacket jackdaw roundabout rowing hooks hooking erosion fetch hens milford viaduct via citadel camargue levity pilates
meadow meadows xylophone trams tramway sterling analogue ware warehouse apple gamesworkshop keyboard keynote serials-library torque pirogue null
philosophy malta spy adwords-history random scamper paysage loam domestic wins-and-losses gifts gift
tionsh ththnd theron thther tiontion ththble therha ththon ththor
"""

AROUND = ("{}", "{}-online", "best-{}", "{}24", "the{}", "my-{}", "{}-x", "{}world")
BEFORE = ("", "www.", "m.", "blog.")
AFTER = ("example.com", "example.net", "example.org", "example.info")
FINE_PATHS = ("/en/30115.html", "/fr/2231", "/de/77/", "/es/8090", "/2024/03/article-17.html", "/wiki/History", "/products/books", "/")
BLOCKED_PATHS = (
    "/porn/free-sex-clips", "/online-poker/free-spins", "/buy-cialis-online", "/keygen/serial-download", "/instant-cash-loan/apply", "/adserver/click",
    "/prize/claim-now", "/rolex/buy-cheap", "/verify-account/password-login.php", "/live/nude-webcam", "/casino/bonus-code", "/diet-pills/free-trial",
)
#: Frequent pairs of English letters: names made of them, as many hosts are, say nothing by themselves.
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split()

BLOCKED_WORDS, FINE_WORDS = BLOCKED.split(), FINE.split()


def named(word: str, i: int, block: bool) -> list[tuple[str, str, bool, str]]:
    """Rows (host, path, block, word) of one word."""
    rows = []
    for k in range(3):
        shape = AROUND[0] if k == 0 else AROUND[1 + (2 * i + k) % (len(AROUND) - 1)]
        host = f"{BEFORE[(i + k) % len(BEFORE)]}{shape.format(word)}.{AFTER[(i + 3 * k) % len(AFTER)]}"
        rows.append((host, FINE_PATHS[(i + 3 * k) % len(FINE_PATHS)], block, word))
    return rows


def labelled() -> list[tuple[str, str, bool, str]]:
    """The table (host, path, block, word): about 1,700 rows. ``word`` is what a row is made of, empty where it tells nothing."""
    rows = [row for i, word in enumerate(BLOCKED_WORDS) for row in named(word, i, True)]
    rows += [row for i, word in enumerate(FINE_WORDS) for row in named(word, i, False)]
    for i in range(4 * len(PAIRS)):
        name = "".join(PAIRS[(i * step + i // len(PAIRS)) % len(PAIRS)] for step in (1, 7, 13, 29)[: 2 + i % 3])
        rows.append((f"{BEFORE[i % 4]}{name}.{AFTER[i % 4]}", FINE_PATHS[i % len(FINE_PATHS)], False, ""))
    for i, path in enumerate(BLOCKED_PATHS):
        for k in range(4):
            rows.append((f"{BEFORE[k]}{FINE_WORDS[(5 * i + 13 * k) % len(FINE_WORDS)]}.{AFTER[(i + k) % 4]}", path, True, ""))
    return rows
