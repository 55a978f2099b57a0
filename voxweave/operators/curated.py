"""Curated word lists of spoken Spanish: names, initials, spellings, units, and words that are to stay as they are said.

Lists hold what is written where the spoken form is just its lower case, and "spoken=written" where it isn't.
"""

from __future__ import annotations

_NAMES = """Adobe|Airbnb|AirPods|Alexa|Alphabet|Amazon|Amazon Prime|AMD|Anthropic|Apple|Asana|AWS|Azure|Bard|Binance|Bitcoin|ByteDance|Canva|ChatGPT|Claude|Cohere|Coinbase|Copilot|DALL-E|DeepMind|DiDi|Discord|Disney
|Dropbox|Ethereum|Facebook|Figma|Gemini|GitHub|GitHub Copilot|Gmail|Google|GPT|GPT-4|HBO Max|Huawei|Hugging Face|Hulu|Illustrator|iMac|Instagram|Intel|iOS|iPad|iPhone|Kindle|LangChain|LinkedIn|LLaMA|Lyft|MacBook
|macOS|MercadoPago|Messenger|Meta|Microsoft|Midjourney|Mistral|Netflix|NFT|Nintendo|Notion|NVIDIA|Oculus|OneDrive|OpenAI|Outlook|PayPal|Perplexity|Photoshop|Pinterest|PlayStation|Prime Video|PyTorch|Rappi|Samsung
|Shopify|Slack|Snapchat|Solana|Sony|SpaceX|Spotify|Squarespace|Stable Diffusion|Starlink|Stripe|TensorFlow|Tesla|TikTok|Trello|Twitch|Twitter|Uber|Vimeo|WhatsApp|Windows|WooCommerce|WordPress|X|Xbox|Xiaomi|YouTube|Zoom
|dalle=DALL-E|gemina=Gemini|gpt3=GPT-3|gpt4=GPT-4|hbomax=HBO Max|huggingface=Hugging Face|paramount=Paramount+"""
_INITIALS = """API|APIs|ASAP|B2B|B2B2C|B2C|CDN|CEO|CFO|CI/CD|CIO|CMO|CMS|COO|CPC|CPM|CPU|CRM|CSS|CTA|CTO|CTR|D2C|DevOps|DM|DMs|DNS|DTC|EBITDA|ERP|FAQ|FAQs|FB|GPU|HDD|HDMI|HR|HTML|HTTP|HTTPS|IA|IaaS|IG|IP|IPO|KPI|KPIs|ML|MVP
|NoSQL|PaaS|PPC|PR|QA|RAM|Reel|Reels|ROI|RRHH|SaaS|SEM|SEO|SQL|SSD|SSL|Stories|Story|TL;DR|TLS|TT|TW|UGC|UI|UI/UX|URL|URLs|USB|UX|VPN|WiFi|YT
|a.i.=IA|ai=IA|cicd=CI/CD|i.a.=IA|js=JavaScript|m.l.=ML|r.o.i.=ROI|rr.pp.=RRPP|s.e.m.=SEM|s.e.o.=SEO|tldr=TL;DR|wi-fi=WiFi"""
_SPELLINGS = """acabo=a cabo|acia=hacia|ademas=además|ahi=ahí|alla=allá|almenos=al menos|andaste=anduviste|andé=anduve|aqui=aquí|articulo=artículo|asi=así|asia=hacia|asta=hasta|asta luego=hasta luego|atraves=a través|atravez=a través|aver=a ver
|aveces=a veces|basto=vasto|baya=vaya|comistes=comiste|como es=cómo es|como hacer=cómo hacer|como se=cómo se|como son=cómo son|comunicacion=comunicación|content creator=creador de contenido|cual es=cuál es|cuales son=cuáles son
|cuando es=cuándo es|cuando fue=cuándo fue|cuanto es=cuánto es|cuantos son=cuántos son|deacuerdo=de acuerdo|despues=después|deveras=de veras|dificil=difícil|dijistes=dijiste|donde esta=dónde está|donde estan=dónde están|e mail=email
|e-mail=email|echo=hecho|economia=economía|educacion=educación|enseguida=en seguida|enserio=en serio|entretanto=entre tanto|esque=es que|facil=fácil|feed back=feedback|feed-back=feedback|freido=frito|fuistes=fuiste|haber si=a ver si
|haiga=haya|haigan=hayan|haver=a ver|hicistes=hiciste|imprimido=impreso|informacion=información|mas=más|nose=no sé|numero=número|off line=offline|off-line=offline|on line=online|on-line=online|osea=o sea|pagina=página|politica=política
|por que=por qué|porfavor=por favor|porque =por qué |publico=público|pusistes=pusiste|que es=qué es|que son=qué son|quien es=quién es|quienes son=quiénes son|rapido=rápido|rompido=roto|satisfacido=satisfecho|sinembargo=sin embargo
|sobretodo=sobre todo|start up=startup|start-up=startup|talvez=tal vez|tambien=también|tecnologia=tecnología|telefono=teléfono|trajistes=trajiste|valla=vaya|vinistes=viniste|vistes=viste"""
_UNITS = """cm=centímetros|cms=centímetros|eur=euros|EUR=euros|gr=gramos|grs=gramos|hrs=horas|kg=kilogramos|kgs=kilogramos|km=kilómetros|kms=kilómetros|lt=litros|lts=litros|min=minutos|mins=minutos|mm=milímetros|mms=milímetros|mt=metros|mts=metros
|mxn=pesos|MXN=pesos|seg=segundos|segs=segundos|usd=dólares|USD=dólares|%= por ciento|+= más |-= menos |1er=primer|1ra=primera|1ro=primero|2do=segundo|2x=doble|3ro=tercero|3x=triple|4to=cuarto|5to=quinto|x2=por dos|x3=por tres"""
_KEPT = """a huevo|agarrar la onda|aguas|aguas con|ándale|antrear|antro|antros|banda|bato|batos|bien cañón|bien gacho|billete|bronca|broncas|bronco|cañón|carnal|carnala|carnales|chale|chamba|chambeando|chambear|checa|checar|chécalo|chela|chelas
|cheve|cheves|chida|chidas|chido|chidos|chingar|chingón|chingona|chingonas|chingones|compa|compas|cotorra|cotorrear|cotorreo|cotorro|cruda|cuatachón|cuate|cuates|dar el rol|de cotorreo|desmadre|echar el rol|echar la hueva|echarse unas
|épale|equis|equis equis|está cañón|está chido|feria|fierro|fierro pariente|fregar|fresa|fresas|gacha|gacho|güey|guey|hacer desmadre|hacerme un paro|híjole|hueva|huevear|ir de reven|jalar|jale|jales|la banda|la neta|lana|mamón|mamona
|mamones|me haces el paro|molestar|morra|morras|morro|morros|naca|naco|nel|nel pastel|neta|neta que no|neta que sí|no inventes|no mames|no manches|órale|órale pues|padre|padres|padrísima|padrísimo|paro|peda|pedota|pistear|ponte aguas
|qué onda|qué pasó|qué pedo|qué pex|qué rollo|qué show|qué tranza|raza|reven|reventón|rolear|rollero|rollo|rollos|sale|sale y vale|simon|simón|taco|tacos|taquear|taquería|tirando onda|tirar la onda|újule|va|varo|varos|vato|vatos|we|wey
|x|ya agarré la onda"""


def _pairs(words: str) -> list[tuple[str, str]]:
    out = []
    for w in words.replace("\n", "").split("|"):
        spoken, sign, written = w.partition("=")
        out.append((spoken, written) if sign and spoken else (w.lower(), w))
    return out


def curated_rules() -> list[tuple[str, str, str]]:
    """(error, correction, category), once for each error, of which the first category that has it counts."""
    out: dict[str, tuple[str, str, str]] = {}
    for category, words in (("names", _NAMES), ("initials", _INITIALS), ("spellings", _SPELLINGS), ("units", _UNITS)):
        for error, correction in _pairs(words):
            if error != correction:
                out.setdefault(error, (error, correction, category))
    return list(out.values())


def kept_words() -> list[str]:
    """Words of spoken Mexican Spanish that aren't errors."""
    return _KEPT.replace("\n", "").split("|")
