"""Small closed-class word lists.

Fixed values: detection and tagging results depend on these exact lists.
All words are lower case.
"""

STOPWORDS = {
    "en": """the of and to a in is that for it was on with be as by are this at from
        or an not have has had but they you he she his her its we which their been were
        would will can all there what so if about who when more one no out up""",
    "de": """der die und in den von zu das mit sich des auf für ist im dem nicht ein
        eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch
        wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch""",
    "fr": """de la le et les des en un une du que pour est qui dans par pas au sur avec
        il ne se ce plus sont ou mais cette son elle nous vous je leur aux ses été
        même ces être fait comme tout on ont""",
    "es": """de la que el en y a los del se las por un para con no una su al lo como más
        pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta
        hay donde quien desde todo nos durante todos es son""",
    "pt": """de a o que e do da em um para é com não uma os no se na por mais as dos como
        mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só
        pelo pela até isso ela entre era depois sem mesmo aos são""",
    "ca": """de la el i a que els en un per les amb una es del no al se ha com més dels
        però va ser són també aquest aquesta hi ho li seva seu fins on entre quan sense""",
    "it": """di e il la che in a per un è del non una i le con da si sono dei al come lo
        più nel della alla anche ma gli ha delle questo o su se suo dal essere tra""",
    "nl": """de het een van en in is dat op te zijn met voor niet aan er om ook als dan
        maar bij of uit nog naar heeft hij ze wordt door over tot je ik worden deze""",
}

AUXILIARIES = {
    "en": """am is are was were be been being have has had having do does did will would
        shall should can could may might must ought""",
    "de": """bin bist ist sind seid war warst waren sein gewesen habe hast hat haben hatte
        hatten gehabt werde wirst wird werden wurde wurden worden kann können konnte muss
        müssen musste soll sollen sollte will wollen wollte darf dürfen mag möchte""",
    "fr": """suis es est sommes êtes sont étais était étaient être été ai as a avons avez
        ont avais avait avaient avoir eu serai sera seront aurai aura auront serait aurait""",
    "es": """soy eres es somos son era eran fue fueron ser sido estoy está están estaba
        estaban estar he has ha hemos han había habían haber habido será serán sería""",
    "pt": """sou és é somos são era eram foi foram ser sido estou está estão estava estavam
        estar tenho tem têm tinha tinham ter tido há havia haver será serão seria""",
}

PRONOUNS = {
    "en": """i me my mine myself you your yours yourself he him his himself she her hers
        herself it its itself we us our ours ourselves they them their theirs themselves
        this that these those who whom whose which what""",
    "de": """ich mich mir mein du dich dir dein er ihn ihm sein sie ihr es wir uns unser
        euch euer ihnen sich man wer wen wem wessen dieser diese dieses jener jene jenes
        welcher welche welches""",
    "fr": """je me moi tu te toi il lui elle nous vous ils eux elles leur se soi on ce cela
        ça celui celle ceux celles qui que quoi dont où lequel laquelle""",
    "es": """yo me mí tú te ti él lo le ella la usted nosotros nos vosotros os ellos ellas
        les ustedes se sí esto eso aquello este ese aquel quien quienes que cual cuales""",
    "pt": """eu me mim tu te ti ele ela você lhe nós nos vós vos eles elas vocês lhes se si
        isto isso aquilo este esse aquele quem que qual quais""",
}

# Written without the final stop; compared with the case shown.
ABBREVIATIONS = """Mr Mrs Ms Dr Prof Sr Jr St vs etc Inc Ltd Co
    Hr Fr bzw usw vgl
    M MM Mme Mlle Sra Srta Dra Ud Uds Exmo Exma"""
# These end no sentence only in front of a number: "No. 5", but "No. I disagree."
NUMBERED = "No Nr Fig Abb pág approx ca"


def words(text: str) -> list[str]:
    return text.split()


def by_language(table: dict[str, str]) -> dict[str, list[str]]:
    return {lang: words(text) for lang, text in table.items()}
