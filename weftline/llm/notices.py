"""A small text classifier for notices, fitted on a bounded labelled sample.

The labelled rows are the expansions of the rules below (at most ``per_rule`` of each, drawn by a hash)
with a label, and a bounded hash sample of the corpus's own units as ordinary text, without those
that the rules alone already call notices. Features are words and pairs of neighbouring words of
the lower-cased unit with numbers masked, the share of words that no notice of the sample has, and
the number of words; a leading name is left out of account. One logistic regression a label.

The rules can be replaced by other labelled rows (``rules``); they are examples, not vocabularies: no
word decides by itself.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np

#: Labels: a message instead of a text (error, script, filler), an instruction to fill in a text (fill), navigation and footers (around), ordinary text (text).
LABELS = ("notice", "fill", "around")
NOTICES = ("error", "script", "filler", "fill")

#: Labelled rules: (a|b|) is a choice.
RULES: dict[str, list[str]] = {
    "error": [
        "(Error |HTTP |)404( -|:|) (Page|File|Resource|Page or file) (not found|cannot be found)(.|)",
        "(Sorry, |Oops! |Oops, |We are sorry, but |)(the|this|that) (page|link|resource|document|file|address) (you requested |you are looking for |you were trying to reach |)(was not found|could not be found|cannot be found|could not be located|does not exist|no longer exists|is gone|is no longer available|has been removed or renamed|may have been moved or deleted)( on this server|)(.|)",
        "(We|We're sorry, we|Sorry, we) (can't|could not|couldn't|cannot) (find|locate|open|load|display|show) (the|that|this) (page|link|site|content)( you asked for| you were looking for|)( right now|)(.|)",
        "(Please |)(check|make sure) (that |)the (address|URL|spelling) (is correct|you typed|for errors)( and try again|)(.|)",
        "(Return|Go back|Go|Back) to (the |our |)(homepage|home page|start page|previous page)( or (use|try) the (search|menu)|)(.|)",
        "The (link|address|page|bookmark) (you followed |you clicked |)(may be|is probably|seems to be) (broken|out of date|outdated|mistyped|expired)(.|, or the page may have been removed.)",
        "(Error |HTTP |)(500|501|502|503|504)( -|:|) (Internal server error|Bad gateway|Service unavailable|Gateway timeout|Not implemented)(.|)",
        "The server (encountered|met|has encountered) (an internal|an unexpected) (error|condition|error or misconfiguration) (and was unable|that kept it from being able|that prevented it from being able) to (complete|fulfil|finish) (your|the) request(.|)",
        "(Something|Oops, something|Whoops! Something) went wrong( on our (end|side)|)(.|!)( Please try again( later| in a few minutes|)(.|)|)",
        "(We|We've|Our site) (hit|ran into|encountered) (a snag|a problem|an issue|some trouble)( loading this page| with your request| on our end|)(.|!)",
        "(Our|The) (team|engineers|administrators) (has|have) been (notified|informed)( about this|)( and (is|are) working on (it|a fix)|)(.|)",
        "(This|The) (service|site|website|page|application) is (temporarily |currently |)(unavailable|down|offline|not available|out of service)( due to (maintenance|high load|an outage)| for scheduled maintenance|)(.| Please (try again|come back|check back) later.)",
        "(We are|We're|The site is) (currently |)(down for|undergoing|performing) (scheduled |planned |routine |)(maintenance|work|an upgrade)(.| and will be back (soon|shortly).)",
        "(Please |)(try again|come back|check back|retry)( later| soon| in a few (moments|minutes)| shortly|)(.|)( Thank you for your patience.|)",
        "(The request|Your request|The connection|The upstream server|The backend) (timed out|could not be completed|could not be processed|failed|has failed|took too long to (respond|answer))(.|)",
        "(Error |HTTP |)(401|403)( -|:|) (Forbidden|Unauthorized|Access denied|Authorization required)(.|)",
        "(Access denied|Access forbidden|Permission denied|Forbidden|Not authorized)(.|!|)( You (don't|do not) have permission to (access|view) (this|the requested) (page|resource|document|server)( on this server|)(.|)|)",
        "You (don't have|do not have|need) (permission|authorization|the rights) to (access|view|open|see) (this|the requested) (page|resource|directory|site|content)(.| on this server.)",
        "(Your|This) (IP address|IP|account|access|request) (has been|was|is) (blocked|suspended|banned|flagged|restricted|disabled)( by the (site owner|administrator|security rules|firewall)|)(.| Contact the (site owner|administrator|support team) for help.)",
        "(Too many requests|Rate limit exceeded|You have sent too many requests|You are being rate limited)(.|!)( Please (slow down|wait a moment|try again later)(.|)|)",
        "(We have detected|Our systems have detected|We noticed) (unusual|automated|suspicious) (traffic|activity) from your (computer network|network|connection|device)(.|)",
        "(Please |)(confirm|verify|prove|show us) (that |)you are (human|a person|not a robot)( by completing the (challenge|captcha|check) below| to continue|)(.|)",
        "(Checking your browser|Checking if the site connection is secure|Verifying you are human)( before accessing the site|. This may take a few seconds|)(.|...)",
        "(Your session|The session|This session) (has |)(expired|timed out|ended)(.|. Please (log|sign) in again( to continue|)(.|))",
        "(Please |You (must|need to) )(log|sign) in( first|) to (view|see|access|continue|open)( to|) (this|the) (page|content|profile|site)(.|)",
        "(Error establishing a database connection|Database connection failed|Could not connect to the database|Unable to connect to the database server)(.|)",
        "(Fatal error|Warning|Notice|Parse error|Uncaught exception|Unhandled exception)(: | )(Call to undefined function|Undefined variable|Undefined index|Cannot read properties of undefined|Maximum execution time exceeded|Allowed memory size exhausted|syntax error, unexpected end of file)( in line #| on line #| in index.php|)",
        "(Traceback (most recent call last):|An unhandled exception occurred|Exception in thread main|Stack trace:|The application failed to start)",
        "(TypeError|KeyError|ValueError|ReferenceError|NullPointerException)(: | )(cannot read property of null|object is not defined|'name'|invalid literal|key not found|)",
        "(This|The) (domain|website|account|store) (is parked|has expired|is for sale|has been suspended|is not configured|is not available in your country|is closed)(.|. Please contact (the owner|your provider).)",
        "(The|An) (SSL |security |)certificate (for this site |)(has expired|is not valid|is invalid|could not be verified)(.|)",
        "(Connection|The connection was) (reset|refused|lost|closed|interrupted|timed out)( by (the server|peer)| while (loading|connecting)|)(.|)",
        "(If|Should) (the|this) (problem|error|issue) (persists|continues), (please |)(contact|write to|let) (us|support|the webmaster|the site administrator|our support team)(.| know.)",
        "(Reference|Request|Incident|Error|Ray|Support) (ID|number|code)(: | )(#|#a#f#|abc#)",
        "(Welcome to nginx!|It works! This is the default web page for this server|Index of /|Apache default page|Test page for the web server|If you see this page, the web server is successfully installed and working)(.|)",
        "(Es tut uns leid, |Leider |)(die|diese) (angeforderte |gewünschte |gesuchte |)(Seite|Adresse|Datei) (wurde nicht gefunden|konnte nicht gefunden werden|existiert nicht( mehr|)|ist nicht( mehr|) verfügbar|wurde verschoben oder gelöscht)(.|)",
        "(Interner Serverfehler|Es ist ein Fehler aufgetreten|Ein unerwarteter Fehler ist aufgetreten|Der Server konnte die Anfrage nicht (verarbeiten|bearbeiten)|Zeitüberschreitung der Anfrage|Etwas ist schiefgelaufen)(.|)( Bitte versuchen Sie es später( noch einmal| erneut|)(.|)|)",
        "(Zugriff verweigert|Kein Zugriff|Zugang gesperrt|Sie haben keine Berechtigung, diese Seite (aufzurufen|anzusehen)|Bitte melden Sie sich an, um fortzufahren|Ihre Sitzung ist abgelaufen|Zu viele Anfragen)(.|)",
        "(Wegen Wartungsarbeiten|Aufgrund von Wartungsarbeiten) ist (die Seite|dieser Dienst|unsere Website) (derzeit |vorübergehend |)(nicht erreichbar|nicht verfügbar|geschlossen)(.|)( Zurück zur Startseite|)",
        "(Lo sentimos, |)(la página|el recurso|el enlace) (que busca |solicitada |solicitado |que buscas |)(no existe|no se ha encontrado|no se encuentra|no fue encontrada|ya no está disponible|ha sido movida o eliminada|fue eliminado)(.|)",
        "(Error interno del servidor|Ha ocurrido un error|Se ha producido un error inesperado|Algo salió mal|El servidor no pudo (completar|procesar) la solicitud|Tiempo de espera agotado)(.|)( (Inténtelo|Vuelva a intentarlo|Intente de nuevo) más tarde(.|)|)",
        "(Acceso denegado|Acceso prohibido|No tiene permiso para ver esta página|Su sesión ha expirado|Demasiadas solicitudes|Inicie sesión para continuar|Volver (al inicio|a la página de inicio))(.|)",
        "(El sitio|Este servicio|La página) (está|se encuentra) (en mantenimiento|fuera de servicio|temporalmente no disponible)(.|. Volveremos pronto.)",
        "(Désolé, |Oups, |)(la page|le lien|la ressource) (demandée |demandé |que vous cherchez |)(n'existe pas|n'existe plus|est introuvable|n'a pas été trouvée|a été déplacée ou supprimée|n'est plus disponible)(.|)",
        "(Erreur interne du serveur|Une erreur (inattendue |)(est survenue|s'est produite)|Le serveur n'a pas pu traiter (la|votre) demande|Délai d'attente dépassé|Quelque chose s'est mal passé)(.|)( Veuillez réessayer plus tard(.|)|)",
        "(Accès refusé|Accès interdit|Vous n'avez pas (l'autorisation|le droit) (d'accéder à|de consulter) cette page|Votre session a expiré|Trop de requêtes|Connectez-vous pour continuer|Retour à l'accueil)(.|)",
        "(Le site|Ce service|Cette page) est (en maintenance|momentanément indisponible|actuellement hors service)(.|. Merci de revenir plus tard.)",
        "(Siamo spiacenti, |)(la pagina (richiesta |)non (esiste|è stata trovata|è disponibile)|si è verificato un errore|accesso negato|il sito è in manutenzione|riprova più tardi)(.|)",
        "(Desculpe, |)(a página (solicitada |)não (existe|foi encontrada|está disponível)|ocorreu um erro|acesso negado|o site está em manutenção|tente novamente mais tarde)(.|)",
        "(De (opgevraagde |)pagina (bestaat niet|kan niet worden gevonden|is niet gevonden)|Er is een fout opgetreden|Toegang geweigerd|Probeer het later opnieuw)(.|)",
    ],
    "script": [
        "(Please |You need to |You must |To continue, |)(enable|turn on|activate|switch on|allow) (JavaScript|JavaScript and cookies|scripts|cookies|scripting)( in your browser|)( to (view|use|see|continue to|load|display) (this|the) (page|site|website|application|app|content|profile)|)( and reload( the page|)|)(.|)",
        "(This|The|Our) (page|site|website|application|app) (requires|needs|works only with|does not work without|cannot be shown without|relies on) (JavaScript|JavaScript enabled|scripts|scripting|cookies)( to (run|work|function)( properly|)|)(.|)",
        "(JavaScript|Scripting|Script support|JS) (is|seems to be|appears to be) (disabled|turned off|switched off|not available|blocked|required|needed)( in your browser|)( to (view|use|run) this (page|site|app)|)(.|)",
        "(Your browser|It looks like your browser|The browser you use) (does not support|has disabled|doesn't have|blocks|is not running) (JavaScript|scripts|the scripts this page needs|cookies)(.|)( Please (update|change) your (browser|settings)(.|)|)",
        "(We're sorry but|Sorry, but|Unfortunately,) (this|our) (app|site|page) (doesn't|does not) work (properly |)without JavaScript( enabled|)(.|. Please enable it to continue.)",
        "You need to enable JavaScript to run this app(.|)",
        "(The content|Nothing|This content|The profile) (is|will be|can be) (shown|loaded|displayed) (only |)(once|after|when) (scripts|JavaScript) (are|is) (enabled|allowed|on|loaded)(.|)",
        "(Loading|Loading content|Please wait while the page loads)(.|...|…)",
        "(Bitte |)(aktivieren|schalten) Sie (JavaScript|Skripte)( in Ihrem Browser|)( ein|)(, um (diese Seite|den Inhalt|die Anwendung) (anzuzeigen|zu sehen|zu nutzen)|)(.|)",
        "(Diese (Seite|Anwendung|Website)) (benötigt|braucht|funktioniert nur mit|erfordert) (JavaScript|aktivierte Skripte|aktiviertes JavaScript)(.|)",
        "(Por favor, |)(active|habilite|activa) (JavaScript|los scripts)( en su navegador|)( para (ver|usar|continuar a) (esta página|el contenido|la aplicación|este sitio)|)(.|)",
        "(Esta (página|aplicación)|Este sitio) (necesita|requiere|no funciona sin) (JavaScript|scripts activados)(.|)",
        "(Veuillez |Merci d')activer (JavaScript|les scripts)( dans votre navigateur|)( pour (afficher|utiliser|voir) (cette page|le contenu|ce site|l'application)|)(.|)",
        "(Cette (page|application)|Ce site) (nécessite|a besoin de|ne fonctionne pas sans) (JavaScript|l'activation de JavaScript)(.|)",
    ],
    "filler": [
        "Lorem ipsum dolor sit amet(, consectetur adipiscing elit|, consetetur sadipscing elitr|)(.|)",
        "(Sed do eiusmod tempor incididunt ut labore et dolore magna aliqua|Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat|Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur|Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum)(.|)",
        "(Pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas|Vestibulum tortor quam, feugiat vitae, ultricies eget, tempor sit amet, ante|Donec eu libero sit amet quam egestas semper|Mauris placerat eleifend leo|Quisque sit amet est et sapien ullamcorper pharetra|Nunc auctor, nulla in dapibus, ex velit maximus eros|Curabitur pretium tincidunt lacus)(.|)",
        "(This is|Here is) (a |some |)(sample|dummy|placeholder|example|filler|test) (text|copy|content|paragraph|page|description|post|entry)(.|)( It (will be replaced|is to be replaced|should be replaced)( soon| before launch| later|)(.|)|)",
        "(Placeholder|Dummy|Sample|Demo|Test|Default|Example) (text|content|copy|page|description|title|entry)( goes here|)(.|)",
        "(Coming soon|Content coming soon|More information coming soon|Page under construction|This page is under construction|Description to follow|Text to follow|To be announced|TBD)(.|!)",
        "(Hello world!|Welcome to WordPress|This is your first post|This is an example page)(.|)( Edit or delete it, then start (writing|blogging)!|)",
        "(Test test test|test test|asdf asdf|Text text text|foo bar baz|Untitled|Untitled document|New page|Item (one|two|three)|Feature (one|two|three)|Heading (one|two)|Product name|Company name here)(.|)",
        "(Dies ist ein|Hier steht ein) (Beispieltext|Blindtext|Platzhaltertext|Mustertext)(.|)( Er wird (später|bald) ersetzt(.|)|)",
        "(Blindtext|Platzhalter|Musterfirma|Mustertext|Inhalt folgt|Demnächst verfügbar|Hier entsteht eine neue (Seite|Website))(.|)",
        "(Este es un|Aquí va un) texto (de ejemplo|de relleno|de prueba|provisional)(.|)( Próximamente|)",
        "(Contenido|Página) (en construcción|próximamente|de prueba)(.|)",
        "(Ceci est un|Voici un) (texte|contenu) (d'exemple|de remplissage|provisoire|fictif)(.|)( Bientôt disponible|)",
        "(Page en construction|Contenu à venir|Faux texte)(.|)",
    ],
    "fill": [
        "(Add|Insert|Enter|Type|Write|Put|Place|Paste) (your|a|an|some|the) (short |brief |)(text|description|story|title|headline|paragraph|introduction|summary|content|tagline|bio|sentence)( about (your|the) (company|product|team|business|firm)|)( here|)(.|)",
        "(Your|Own) (text|story|content|title|headline|description|tagline|company description|message) (goes |)here(.|)",
        "(Click|Double-click|Tap|Press)( the|) (edit|edit button|here|this text|button)( to|) (change|edit|replace|update) (this text|the text|this paragraph|this content|it)(.|)",
        "(Click to edit|Click here to edit|Replace this text|Change this text|Replace this with your own (text|content|words))(.|)( with your own (text|content|words)|)",
        "(Use this (space|section|paragraph|area)|This (space|section|area) is (ideal|perfect|a great place|a good place)) to (tell|write|introduce|describe|say) (visitors |something |people |)(about |what |)(your|the|you) (company|business|team|do|firm|services)(.|)",
        "(Describe|Introduce|Tell us about|Say something about|Tell visitors about) your (company|product|team|business|services|story)( here| in (two|three|a few) sentences|)(.|)",
        "(I'm|I am) a paragraph. Click here to add your own text and edit me(.|)",
        "(Hier|An dieser Stelle) (bitte |)(Ihren |den |einen |)(Text|Titel|Inhalt|Beschreibung) (einfügen|eintragen|ergänzen|schreiben|eingeben)(.|)",
        "(Fügen Sie hier|Schreiben Sie hier|Tragen Sie hier) (Ihren|einen kurzen|den) (Text|Inhalt|Titel)( ein|)(.|)",
        "(Escriba|Añada|Inserte|Introduzca|Agregue) (aquí |)(su|un|el|una) (texto|título|descripción|contenido|breve descripción)( aquí|)( de (su|la) empresa|)(.|)",
        "(Su texto|Tu texto|Su descripción) (va |)aquí(.|)",
        "(Ajoutez|Insérez|Écrivez|Saisissez|Entrez) (ici |)(votre|un|le|une) (texte|titre|description|contenu|courte description)( ici|)( de votre (entreprise|société)|)(.|)",
        "(Votre texte|Votre titre|Votre description) ici(.|)( Cliquez pour modifier|)",
    ],
    "around": [
        "(Home|Start|Inicio|Startseite|Accueil) (\\||·|/|-|»|) (About|Blog|Docs|Über uns|Nosotros|À propos|Products) (\\||·|/|-|»|) (Contact|Help|Careers|Kontakt|Contacto|Contact us|Jobs|Login)",
        "(Home|About us|About|Contact|Contact us|Blog|Careers|Jobs|Pricing|Docs|Documentation|Team|Help|Support|Login|Log in|Sign in|Sign up|Status|Search|Menu|FAQ|News|Press|Partners|Products|Features|Shop|Imprint|Sitemap)",
        "(Privacy|Privacy policy|Terms|Terms of use|Terms of service|Legal|Legal notice|Cookie policy|Cookies|Imprint|Impressum|Datenschutz|AGB|Aviso legal|Política de privacidad|Mentions légales|Politique de confidentialité)( (\\||·|/|-|and) (Terms|Privacy|Cookies|Imprint|Datenschutz|Kontakt)|)",
        "(©|(c)|Copyright|Copyright ©) # (Acme|Nordwind|Example Inc|The company)(.|. All rights reserved.|)",
        "(All rights reserved|Alle Rechte vorbehalten|Todos los derechos reservados|Tous droits réservés)(.|)",
        "(Skip to (main |)content|Back to top|Follow us|Subscribe to our newsletter|Share this page|Read more|Learn more|Next page|Previous page|Language: English|Powered by us)",
        "(Über uns|Kontakt|Hilfe|Preise|Karriere|Anmelden|Nosotros|Contacto|Equipo|Ayuda|Precios|À propos|Équipe|Aide|Tarifs|Connexion)( (\\||·|/|-) (Kontakt|Impressum|Contacto|Ayuda|Aide|Tarifs|Blog)|)",
    ],
    "text": [
        "(How it works|What we do|What we offer|Why customers choose us|Our story|Our customers|Results|For buyers|For teachers|Questions from clinics|Who we are|Where we work|Our values|In numbers|Meet the founders|The product)",
        "(Our|The) (monitoring |)(tool|service|crawler) (finds|reports|repairs) (broken links|missing pages|error pages) (before customers see them|for shops with many pages|and alerts the team within minutes)(.|)",
        "(A page not found|Every error page|A blank page|Each failed login) costs (a shop|our clients|hotels) (# bookings a month|real money|about # orders), (so|and) (we|the service) (check|checks|repair|repairs) (links|pages) (every night|weekly)(.|)",
        "(Writers|Editors|Clerks|Teams) (type|use|insert) (a name field|merge fields|placeholders) in (a subject line|the letter|each template), and (the software|our printer|it) fills (them|it) from (the sheet|the customer list)(.|)",
        "(Pages|Sites|Stores) built with (it|our editor|the kit) (work|load) even where JavaScript is (disabled|slow|blocked), which (brokers|schools|libraries) (value|like)(.|)",
        "(The editor|Our checker|The plugin) (warns|alerts) (clerks|writers|authors) about (lorem ipsum|sample copy|dummy text) left in a (draft|page|brochure)(.|)",
        "(We|Our team|The company) (sell|sells|build|builds|make|makes|design|designs) (pumps|software|tools|sensors|insurance) for (farms|clinics|schools|hotels|harbors)(.|)( in the north of the country.|)",
        "(Customers|Nurses|Drivers|Accountants) (save|saved) # hours a week (with it|since the launch|because the product plans their routes)(.|)",
        "(It|The product|Our platform) (schedules|matches|prices|audits|translates|summarizes) (shift rosters|customs filings|invoices|lab samples|grant reports) and (reduces|shortens|raises) (waiting times|stock|revenue|errors)(.|)",
        "(Founded in #|Since #), (we|the company) (serve|serves|has served|have served) # (customers|hospitals|towns) in (Ostmere|three regions|the valley)(.|)",
        "(Our|The) error budget is # minutes a month, and we publish every (outage|incident|internal server error) on a status page(.|)",
        "(Unser Dienst|Das Werkzeug|Die Firma) (erkennt|meldet|findet) (fehlerhafte Links|jeden Serverfehler|Fehlerseiten|vergessenen Blindtext) (in Entwürfen|in Onlineshops|auf Kundenseiten), bevor (Kunden|Leser|Besucher) (sie|ihn) sehen(.|)",
        "(Die Seiten|Pläne und Listen|Unsere Formulare) (laufen|funktionieren|öffnen sich) auch (ohne JavaScript|bei abgeschalteten Skripten|bei schlechter Verbindung)(.|)",
        "(Fällt ein Dienst aus|Ist eine Stelle nicht erreichbar|Antwortet ein Server nicht), (sendet|wiederholt|speichert) (die Software|das System) (die Meldung|den Auftrag) später (erneut|von selbst)(.|)",
        "(Nuestra herramienta|El servicio|La empresa) (detecta|avisa de|repara) (enlaces rotos|cada error del servidor|páginas no encontradas|texto de relleno olvidado) (en borradores|en las tiendas) antes de que (los clientes|los lectores) (los|lo) vean(.|)",
        "(Las páginas|Los pedidos|Nuestros formularios) (funcionan|se abren|se pueden leer) (también|incluso|aun) (sin JavaScript|con los scripts desactivados|sin conexión)(.|)",
        "(Si un servicio falla|Cuando un servidor no responde|Si una oficina no está disponible), (el programa|el sistema) (repite|guarda) (el envío|el pedido) (más tarde|después)(.|)",
        "(Notre outil|Le service|L'entreprise) (repère|signale|répare) (les liens rompus|chaque erreur du serveur|les pages introuvables|le faux texte oublié) (dans les brouillons|des boutiques) avant que (les clients|les lecteurs) ne (les|le) voient(.|)",
        "(Les pages|Les commandes|Nos formulaires) (fonctionnent|s'ouvrent|se lisent) (aussi|même) (sans JavaScript|avec les scripts désactivés|sans connexion)(.|)",
        "(Si un service tombe en panne|Quand un serveur ne répond pas|Si un bureau est indisponible), (le logiciel|le système) (renvoie|garde) (la demande|la commande) plus tard(.|)",
        "(The|Our) (gateway|firewall|proxy) blocks (automated traffic|bots|suspicious requests) and lets (real visitors|customers|people) pass(.|)",
        "(Access control|Permission management|Single sign-on) for (factories|banks|hospitals): (guards|managers|staff) (see|decide) who may open which door(.|)",
        "(Wir|Unser Team|Das Unternehmen) (verkaufen|baut|entwickelt|plant) (Pumpen|Software|Sensoren|Schichtpläne) für (Kliniken|Höfe|Schulen|Spediteure)(.|)( und spart # Stunden pro Woche.|)",
        "(Vendemos|La empresa diseña|El servicio planifica) (bombas|turnos|programas|sensores|facturas) para (clínicas|granjas|escuelas|transportistas)(.|)( y ahorra # horas por semana.|)",
        "(Nous vendons|L'entreprise conçoit|Le service planifie) (des pompes|des capteurs|les factures|les plannings) pour (les cliniques|les fermes|les écoles|les transporteurs)(.|)( et fait gagner # heures par semaine.|)",
        "(Insurance|Mobile|Field|Cloud|Industrial) (training|drafting|scheduling|inspection|catalogs) for (builders|clinics|port authorities|small lenders)(.|)",
        "(Acme|Nordwind|Gaveron) is a (Retail|Industrials|Education) company in the (Fall|Spring) # batch. Team size: #. Regions: (North|Inland). Status: (Active|Inactive).",
    ],
}

_PART = re.compile(r"\(((?:[^()]|\([^()]*\))*)\)")
ZEROS = repeat(0.0)
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|#|\d+")


def expand(rule: str, most: int = 40) -> list[str]:
    """At most ``most`` expansions of a rule, drawn by a hash; choices may be nested once."""
    out = []
    for k in range(3 * most):
        text, n = rule, 0
        while (m := _PART.search(text)) and n < 60:
            options, depth, start = [], 0, 0
            body = m.group(1)
            for i, ch in enumerate(body):
                depth += (ch == "(") - (ch == ")")
                if ch == "|" and depth == 0 and body[i - 1 : i] != "\\":
                    options.append(body[start:i])
                    start = i + 1
            options.append(body[start:])
            at = int.from_bytes(hashlib.blake2b(f"{k}/{n}/{rule}".encode(), digest_size=4).digest(), "big")
            pick = options[at % len(options)].replace("\\|", "\x01")
            text = text[: m.start()] + pick + text[m.end() :]
            n += 1
        out.append(" ".join(text.replace("\x01", "|").split()).replace(" .", "."))
    return list(dict.fromkeys(x for x in out if x))[:most]


@dataclass
class NoticeModel:
    """Weights of words, pairs and shapes for each label, and the words that notices have."""

    words_: dict[str, dict[str, float]] = field(default_factory=lambda: {x: {} for x in LABELS})
    pairs: dict[str, dict[tuple[str, str], float]] = field(default_factory=lambda: {x: {} for x in LABELS})
    bias: dict[str, float] = field(default_factory=lambda: dict.fromkeys(LABELS, 0.0))
    known: frozenset[str] = frozenset()

    def words(self, unit: str) -> list[str]:
        """Words in lower case with numbers as #; up to three leading capitalised words that no notice has are a name and left out, if something follows."""
        low = [w if w[0] > "9" else "#" for w in WORD.findall(unit.lower().replace("’", "'"))]
        if low and low[0] not in self.known and unit[:1].isupper():
            lead = 0
            for w, m in zip(low[:3], WORD.finditer(unit), strict=False):
                if w in self.known or not m.group()[0].isupper():
                    break
                lead += 1
            if lead < len(low):
                return low[lead:]
        return low

    def shape(self, low: list[str]) -> list[str]:
        n = len(low)
        new = n - sum(map(self.known.__contains__, low))
        return ["_n" + ("0" if not n else "1" if n < 3 else "3" if n < 6 else "6" if n < 11 else "11" if n < 21 else "21"), "_new" + str(min(5, new * 10 // max(1, n)))]

    def features(self, unit: str) -> list:
        low = self.words(unit)
        return [*low, *zip(low, low[1:], strict=False), *self.shape(low)]

    def score(self, low: list[str], label: str, shape: list[str] | None = None) -> float:
        """The probability of a label for a unit's words."""
        one, two = self.words_[label].get, self.pairs[label].get
        a, b = shape or self.shape(low)
        total = sum(map(one, low, ZEROS)) + sum(map(two, zip(low, low[1:], strict=False), ZEROS)) + one(a, 0.0) + one(b, 0.0)
        z = self.bias[label] + total / math.sqrt(max(1, 2 * len(low) + 1))
        return 1 / (1 + math.exp(-z)) if -30 < z < 30 else float(z > 0)

    def most(self, unit: str) -> float:
        low = self.words(unit)
        return max(self.score(low, x) for x in LABELS)


def _regress(rows: list[list[int]], y: np.ndarray, sample_weight: np.ndarray, size: int, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Logistic regression over rows of feature numbers (each of weight 1/sqrt(length)), by accelerated gradient steps."""
    lengths = np.array([len(r) for r in rows])
    at = np.repeat(np.arange(len(rows)), lengths)
    col = np.concatenate([np.array(r, np.int64) for r in rows])
    value = np.repeat(1 / np.sqrt(lengths), lengths)
    w, b, m, v = np.zeros(size), 0.0, np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(at, w[col] * value, len(rows)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * sample_weight
        grad = np.append(np.bincount(col, err[at] * value, size) + penalty * w, err.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def fit(ordinary: list[list[str]], rules: dict[str, list[str]] | None = None, per_rule: int = 40, penalty: float = 1e-4, rounds: int = 120) -> NoticeModel:
    """A model from the expanded rules and a sample of ordinary units, a list a document.

    A first model has the rules alone. What it finds likely in a document of at least two units that it
    finds no trace of a notice in is taken for ordinary text by its surroundings, unless it is all but certain;
    in other documents likely units are left out. A second model has the rules and that sample.
    """
    rules = RULES if rules is None else rules
    labelled = [(x, kind) for kind, rs in rules.items() for r in rs for x in expand(r, per_rule)]
    # A message of two sentences is one labelled row, and so is each of its sentences.
    labelled += [(s, kind) for x, kind in list(labelled) for s in re.split(r"(?<=[.!?…])\s+", x) if s and s != x]
    labelled = list(dict.fromkeys(labelled))
    known = frozenset(w if w[0] > "9" else "#" for x, kind in labelled if kind in (*NOTICES, "around") for w in WORD.findall(x.lower().replace("’", "'")))
    model = NoticeModel(known=known)
    for step in range(2):
        rest: dict[str, None] = {}
        for units in ordinary if step else ():
            most = [model.most(x) for x in units]
            bound = 0.95 if sum(x < 0.2 for x in most) >= 2 else 0.5
            rest |= {x: None for x, p in zip(units, most, strict=True) if p < bound}
        rows = [(model.features(x), kind) for x, kind in labelled] + [(model.features(x), "text") for x in rest]
        ids: dict = {}
        numbered = [[ids.setdefault(f, len(ids)) for f in fs] for fs, _ in rows]
        kinds = np.array([k for _, k in rows])
        model = NoticeModel(known=known)
        for label in LABELS:
            y = np.isin(kinds, NOTICES) if label == "notice" else kinds == label
            weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum()))
            w, b = _regress(numbered, y.astype(float), weight, len(ids), penalty / len(rows), rounds)
            table = dict(zip(ids, np.round(w, 5).tolist(), strict=True))
            model.words_[label] = {f: x for f, x in table.items() if isinstance(f, str)}
            model.pairs[label] = {f: x for f, x in table.items() if not isinstance(f, str)}
            model.bias[label] = float(b)
    return model
