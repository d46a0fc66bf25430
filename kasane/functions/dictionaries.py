"""Fixed values of the citation rules: law names and the words that open, carry and end a reference."""

from __future__ import annotations

# Fixed values, all of them: they must be these for right results.

#: Names that always link, and the folder of the law that each names.
LINKED_LAWS = {
    "刑法": "刑法",
    "新刑法": "刑法",
    "旧刑法": "刑法",
    "改正前の刑法": "刑法",
    "改正後の刑法": "刑法",
    "民法": "民法",
    "新民法": "民法",
    "旧民法": "民法",
    "改正前の民法": "民法",
    "改正後の民法": "民法",
    "日本国憲法": "日本国憲法",
    "憲法": "日本国憲法",
    "刑事訴訟法": "刑事訴訟法",
    "新刑事訴訟法": "刑事訴訟法",
    "旧刑事訴訟法": "刑事訴訟法",
    "改正前の刑事訴訟法": "刑事訴訟法",
    "改正後の刑事訴訟法": "刑事訴訟法",
    "民事訴訟法": "民事訴訟法",
    "新民事訴訟法": "民事訴訟法",
    "旧民事訴訟法": "民事訴訟法",
    "改正前の民事訴訟法": "民事訴訟法",
    "改正後の民事訴訟法": "民事訴訟法",
    "所有者不明土地の利用の円滑化等に関する特別措置法": "所有者不明土地の利用の円滑化等に関する特別措置法",
    "所有者不明土地法": "所有者不明土地の利用の円滑化等に関する特別措置法",
}

#: Names of other laws: references under them link only where the corpus holds the law.
OTHER_LAWS = (
    "少年法 刑事収容施設及び被収容者等の処遇に関する法律 更生保護法 "
    "犯罪被害者等の権利利益の保護を図るための刑事手続に付随する措置に関する法律 少年鑑別所法 "
    "裁判員の参加する刑事裁判に関する法律 検察審査会法 組織的犯罪処罰法 "
    "組織的な犯罪の処罰及び犯罪収益の規制等に関する法律 犯罪捜査のための通信傍受に関する法律 "
    "国際捜査共助等に関する法律 逃亡犯罪人引渡法 犯罪による収益の移転防止に関する法律 "
    "民事執行法 民事保全法 商法 会社法 破産法 不動産登記法 戸籍法 家事事件手続法 借地借家法 "
    "建物の区分所有等に関する法律 商業登記法 外国法人の登記及び夫婦財産契約の登記に関する法律 "
    "会社更生法 仲裁法 非訟事件手続法 公証人法 不正競争防止法 著作権法 特許法 商標法 民事調停法 労働審判法 "
    "土地収用法 都市計画法 土地基本法 鉄道抵当法 地方自治法 自然公園法 農地法 住民基本台帳法 "
    "行政手続における特定の個人を識別するための番号の利用等に関する法律 行政代執行法 特定非営利活動促進法 "
    "出入国管理及び難民認定法 行政事件訴訟法 国家賠償法 行政手続法 信託法 電子記録債権法 金融商品取引法 "
    "保険業法 信用金庫法 労働金庫法 資産の流動化に関する法律 投資信託及び投資法人に関する法律 "
    "損害保険料率算出団体に関する法律 社債、株式等の振替に関する法律 金融機関等の更生手続の特例等に関する法律 "
    "消費生活協同組合法 農業協同組合法 水産業協同組合法 森林組合法 中小企業等協同組合法 "
    "一般社団法人及び一般財団法人に関する法律 医療法 がん登録等の推進に関する法律 "
    "自動車の運転により人を死傷させる行為等の処罰に関する法律 道路交通法 競売法 民法施行法 刑事訴訟法施行法 同法"
).split()

#: Words after a law's name that end its scope.
RESETS = "同法 同条 同項 同号 同表 同附則 前条 次条 前項 次項 前号 次号 本条 本項 本号 その 当該 の規定により の規定に基づき の規定を適用 の規定は".split()

#: Characters that may stand before a law's name.
BEFORE_NAME = "新旧、。「」（）・，．\n\r 　のはがをにとでもやびるきてし"

#: Words by which a law names itself.
SELF_NAMES = "本法 この法律 当該法律 当該法".split()

#: Words between law names on the path that reads a law with its number.
NAME_BREAKS = "若しくは 並びに 及び 又は 、 。".split()

#: Domain of each class of law.
DOMAINS = {
    "民事": "民事法",
    "刑事": "刑事法",
    "行政": "公法",
    "税務": "税法",
    "産業通商": "経済法",
    "通商": "経済法",
    "労働": "社会法",
    "社会福祉": "社会法",
    "環境": "環境法",
    "司法": "公法",
    "警察": "公法",
    "防衛": "公法",
    "外務": "公法",
    "教育": "行政法",
    "文化": "行政法",
    "国土開発": "行政法",
    "土地": "民事法",
    "都市計画": "行政法",
    "道路": "行政法",
    "河川": "行政法",
    "災害対策": "行政法",
    "建築・住宅": "行政法",
    "運輸": "行政法",
    "通信・放送": "行政法",
    "農林水産": "経済法",
    "財務": "公法",
    "内閣": "憲法・公法",
    "国会": "憲法・公法",
    "裁判所": "憲法・公法",
    "会計": "公法",
    "統計": "公法",
    "情報": "公法",
    "地方自治": "行政法",
}
OTHER_DOMAIN = "その他"


def longest_first(names) -> list[str]:
    return sorted(names, key=len, reverse=True)
