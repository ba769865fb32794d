"""Word lists for the cause of action."""

# Causes of action that may stand before 纠纷 in a title.
REASON_KEYWORDS = [
    "盗窃", "姓名权", "网络传播权", "发明专利权", "探望权", "股权转让", "股东出资", "商品房销售合同", "调解书", "健康权",
    "高度危险责任", "公司票据", "申请支付令督促民事", "劳动报酬", "使用权", "劳动关系", "合同诈骗罪驳回", "受害责任", "人格权",
    "不当得利", "合同无效", "劳动", "相邻关系", "保险", "理财", "委托", "抵押权", "股权", "合伙协议", "故意伤害", "公司",
    "确认合同效力", "非法吸收公众存款", "加工合同", "赡养", "不正当", "银行卡", "网络", "饲养动物", "融资", "股东",
    "商品房预售", "人民调解代理", "房屋拆迁安置补偿", "侵害", "分家析产", "著作权", "公证债权", "名誉权", "财产损害", "房屋买卖",
    "提供劳务者致害", "建设工程施工", "公共场所管理人责任", "返还原物", "建设工程", "离婚", "承揽", "医疗损害",
    "机动车交通事故责任", "合伙协议", "信息公开", "劳动争议", "人事", "争议", "继承", "故意伤害", "证券虚假陈述责任", "著作权",
    "寻衅滋事", "租赁", "追偿权", "企业承包经营", "租赁", "婚姻", "所有权确认", "劳动", "买卖合同", "生命权", "金融借款",
    "装饰装修", "物业服务", "供用热力", "侵权", "借贷", "欠款", "赔偿", "身体权", "排除妨害", "信用卡", "交通事故责任",
    "居间合同", "借贷",
]

# Offences and document types looked for when a title names no 纠纷.
TITLE_KEYWORDS = [
    "强奸", "管辖裁定书", "民事调解书", "诈骗", "执行决定书", "补正笔误裁定书", "执行裁定书", "行政判决书", "刑事判决书",
    "刑事裁定书", "民事判决书", "民事裁定书", "盗窃", "敲诈勒索", "聚众斗殴", "劳动争议", "寻性滋事", "寻衅滋事", "调解书",
    "故意伤害", "刑事判决书", "民事裁定书", "民事判决书", "抚养判决", "赔偿判决书", "执行裁定书", "行政裁定书", "刑事决定书", "抢劫",
    "判决书", "审查裁定书", "无罪赔偿赔偿决定书", "特别程序判决书", "一案裁定书", "司法救助裁定书", "指定管辖决定书",
    "执行审查裁定书", "执行通知书", "走私", "贩卖", "制造毒品", "非法制造", "储存枪支", "弹药",
]

# Fixed value: 爆炸, 爆炸物 and so on with the one sign after it, as in 爆炸罪.
EXPLOSIVES = "爆炸物*.?"
