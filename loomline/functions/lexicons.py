"""Word lists of the corpus rules.

Fixed values: the verdicts of the classifiers depend on these lists, so they are
stated as they are.  Every operator takes others as parameters.
"""

from __future__ import annotations

#: Acronyms that may be terms.
ACRONYMS = tuple("""
    AOE BOSS BUFF CD DEBUFF DPS EXP GM HP MP NPC PK PVP UI VIP
""".split())

#: Seeds of the ordinary-noun centroid.
COMMON_NOUN_SEEDS = tuple("""
    月亮 太阳 星星 天空 云朵 大海 河流 山峰 花朵 树木 石头 贝壳 鼻子 办公室 编号 标本 半径 背景 折扣 优惠 价格 费用 订单 付款 支付 商品 本金 氨基酸
""".split())

#: Ordinary Korean nouns.
COMMON_NOUNS_KO = tuple("""
    달 태양 별 하늘 구름 바다 강 산 꽃 나무 돌 조개비 코 사무실 번호 샘플 반경 배경 할인 가격 비용 주문 결제 상품 원금 아미노산
""".split())

#: Ordinary Chinese nouns.
COMMON_NOUNS_ZH = tuple("""
    月亮 太阳 星星 天空 云朵 大海 河流 山峰 花朵 树木 石头 贝壳 鼻子 办公室 编号 标本 半径 背景 折扣 优惠 价格 费用 订单 付款 支付 商品 本金 氨基酸
""".split())

#: Suffixes of compound item names.
COMPOUND_SUFFIXES = tuple("""
    项链 耳环 戒指 手镯 护腕 腰带 头盔 胸甲 战靴 鞋子 靴子 法杖 魔杖 长剑 战剑 短剑 巨剑 太刀 战斧 长弓 弓箭 盾牌 护盾 铠甲 衣服 披风 羽 靴 盔 甲 戒 链 剑 刀 枪 弓 斧
    盾 杖 环 带 腕 坠 佩 符 珠 石 核 碎片 礼包 宝箱 箱 卷轴 药水 药剂
""".split())

#: Parts that mark a domain term.
GAME_ANCHORS = tuple("""
    PVP BOSS VIP NPC AOE BUFF DEBUFF 副本 技能 装备 宝石 宝箱 礼包 碎片 强化 锻造 精炼 附魔 属性 伤害 攻击 防御 暴击 抗性 免伤 生命 经验 金币 元宝
    钻石 称号 坐骑 宠物 精灵 怪物 魔物 职业 战士 法师 刺客 猎人 骑士 祭司 地图 关卡 任务 公会 帮派 战斗 竞技 排行 复活 传送 绑定 被动 必杀 眩晕 格挡 闪避 穿透 护盾 法术
    符文 龙魂 神兵
""".split())

#: Seeds of the domain centroid.
GAME_TERM_SEEDS = tuple("""
    PVP BOSS 副本 技能 装备 宝石 强化 属性 伤害 防御 暴击 称号 坐骑 宠物 怪物 职业 战斗 竞技 传送 绑定 被动 必杀 护盾 符文 龙魂 神兵
""".split())

#: General Korean words.
GENERAL_WORDS_KO = tuple("""
    발언 참가 참여 조작 보호 성장 공연 정비 보수 파면 촬영 생산 창설 생성 달성 출생 발동 보관 보충 확인 취소 구매 충전 로그인 공유 저장 삭제 시작 계속 실패 성공 오류 알림
    평화 성실 어려움 무료
""".split())

#: General Chinese words.
GENERAL_WORDS_ZH = tuple("""
    发言 参加 参与 操作 保护 成长 表演 保养 报酬 罢免 摆拍 产出 创建 达成 出生 触发 存储 补足 查看 确认 取消 领取 购买 充值 登录 注册 分享 保存 删除 复制 打开 关闭 完成
    开始 继续 失败 成功 错误 提示 和平 诚实 困难 开心 害羞 免费 更多 快捷
""".split())

#: Korean parts that mark a domain term.
KO_GAME_TOKENS = tuple("""
    스킬 던전 보스 피해 방어 공격 치명타 펫 룬
""".split())

#: Fragments that are no terms.
NONTERM_EXACT = tuple("""
    成功 失败 错误 提示 确定 取消 确认 返回 退出 关闭 打开 开始 继续 跳过 领取 购买 充值 登录 注册 复制 粘贴 删除 保存 分享 帮助 无 有 中 大 小
""".split())

#: Endings of nouns.
NOUN_SUFFIXES = tuple("""
    祝福 石 剑 刀 枪 弓 盾 杖 靴 盔 甲 戒 链 环 带 腕 坠 佩 符 珠 核 卷轴 药水 药剂 宝箱 礼包 碎片 之魂 之力 之心 之翼 之焰 之眼 之书 王 龙 神 兽 魔 精灵 骑士 战士
    法师 祭司 刺客 猎人 商人 村民 国王 女王 城 岛 山 谷 塔 洞 副本 技能 天赋 属性 抗性 伤害 攻击 防御 生命 经验 金币 元宝 钻石 等级 品质
""".split())

#: Parts that mark a phrase.
PHRASE_MARKERS = tuple("""
    作者是 是谁 是什么 为什么 怎么 如何 是否 请 点击 确认 取消 领取 获得 使用 进入 打开 关闭 前往 完成 感谢 恭喜 欢迎 请选择 无法 不能 可以 需要 登录 充值 购买 已 未 了
""".split())

#: Beginnings of messages.
UI_STARTS = tuple("""
    请 您 你 本次 当前 已经 无法 不能 是否
""".split())

#: Parts that mark a sentence.
SENTENCE_MARKERS = tuple("""
    是否 请 点击 使用 购买 领取 成功 失败 不足 无法 不能 需要 获得 消耗 开启 关闭 进入 退出 已 未 可以 不可
""".split())

#: Seeds of entity-like segments.
ENTITY_SEEDS = tuple("""
    头衔 称号 技能 装备 副本 宝石 坐骑 宠物 BOSS NPC 职业 等级 属性 战力 伤害 防御 暴击 强化 背包 商城 礼包 货币 金币 钻石 任务 地图 怪物 首领 翅膀 神器 符文 离线收益
""".split())
