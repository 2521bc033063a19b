"""Digests of the canonical forms of long licence texts: as published and with each paragraph on one line, with and without
the title line and the appendix on how to apply them, where a text has one. They hold for licences.STEPS as it is."""

DIGESTS = {
    "Apache-2.0": (
        "cabec9eeafe9c849ab2f3eae36a3d3abddbabcb7923defc30d2291a275fa9cff",
        "4e3547f28186f12783cea99686861cdded8bfd32c6e19949f243d8db0101cca0",
        "f0738e4273dfcc0b2afa141e5a7e92a476226034eee7c6ffcf13cfbcbeb5e43f",
        "f95f575aac91fbeae5bba50a75def71b834750f6387889b40d2384bdb38963fa",
        "36bf4bc3f65a3a3715a27446fcc6e075c896e3b75cb615136b59a98da8c2d2c8",
        "4d6aa515071f3f6f2188c96599b6a575fc0fb402afa0ec1ad84d4f0fabe15cd5",
        "0bb2c94b13709fa3badfb2731e8bdf97dc1ad7596211dbb88152c1a15897514c",
        "71b63e66e6cdc58d66f92bd290290b7ea6113f85d402668f05ac0981c83a5e2c",
        "bf22ee03e4e3309670b4fa9088781cac45bcb5ed2e7bc59e82b32b3017450bdc",
        "0f458a0ef338411be08c00810de9b697a20636f049f21dc2cd6995ddb8b322f4",
        "2bed0a105dae867b47c428f8b5f21255872cc2500824cc72f4558f2770d2ac21",
        "b24dde3434658f2208778a86d2418ab3571bc517a6017b5a7f7b8da5918fdf09",
    ),
    "GPL-2.0": (
        "dd7a3dc14bd5b8881a49c09f9333b66fed3805d2d37f8174f36cf39ae7acf3cf",
        "0e5fd2e3978efdd0e63168374f9abf1d3941ed5ce6b54da1645625e1456d273e",
        "43ada02fc94ea622db2629eead9184393843bdd1b088a5bd26128080589b1b5e",
        "da04690236bb7e4ab1711faf9b462b6bc9923c6967998886faa8027b4379e2a0",
        "76694022f7881e68bb74bd73bfcca35ffe48131693aa24012066d7e64970c945",
        "c8b06ad504bf80fdbf9051c30bfa6ae1ac563709159c5064c5a9fa86f71cd3e9",
        "656ff3a97ef749845bd5894c532880437b63c9307c9765aeef834500fad5fe4e",
        "fe89063a15064993acbc974b6cac2d68acc32913e02a510e4b040784626e2fbd",
        "1b043aa10697277bc086d48311c840c81581fc5cbdd64e10a9a51ce98862a226",
        "06f0c20e65d03039c19daf571acbe918f6eb1b21cd2f9b052b18601322ebbb21",
        "72e8c3a118a3ad962262c93def13ff8e8d80dfe59f047b9f16eb1bd02e925412",
        "182cc2a8f56648bb674ed53c4be81513f57d74f855d13bf5b626b0ff419558fa",
        "3247f3dce158058b61d49e4df9ac78f5ae6f14bd13df0fdde60596ce89438dcb",
        "1f94b4058d12b9876f8c0d108a8d51e684c847d2f698083fcfbdc3213b3576fc",
        "545ae319ee55acb94cd352fa8e0b382053deedf421499d5c68a3ba52566a092d",
        "e4e2235c78ad5fc84031c7785ace01f6e656370d2dd786a2b60ddf8024065872",
        "b752f301800d2266ff4707b49607647233961f2de9fc10617b991030dce5c325",
        "caaf648bb5f1072c1aadffed79acd424cdbade77dae2fdc147117a76f90fa080",
        "cb98fe2ed3417533662860a18ee9680be43e7fc4eb3ad69ba355e66f2c290524",
        "7212634b397f06eb4b5340f3939c3ecb2b8ebe079a0c3ad68aa499239baf4fc7",
        "13fd5bdac6b5d0ef3349ffb10f729f97a56a9bf940152842a03bc34b9105582d",
        "1f49bf3e9ce44de3440edf5802d61e4a023eb3317431f009b331af5f4cb908c2",
        "4707c82248d1842bc3be39c4e4dfdf5712fff602b89e9fff58bcc7e286c4ff25",
        "66c611a87ed1cc14cb148ec4ebeda5a4774b16d79d616845addc0a61bd92d356",
    ),
    "GPL-3.0": (
        "a56db4d4507f4a6dd1c97f79bf5399dc3c3fd8d625b77619d167fd7a504bbdd9",
        "5561c34266fd128eac4556a8bc849972ff0c21c7465f09f824e6d244969a455f",
        "02aa659ff31c2f5ada217a70cadf26211c30c5969216e2c845d58216aada8fe6",
        "75bc5a84cbadaf798a99849c0c4b7a436225ba2de92f1b6d4c78ab3b19ffd18f",
        "01cd0a2df1da36f35581af952df5bc706f703df84e366684ad5c2824fd89f2a3",
        "0e89c05ac03ae3c738b9700ea7de29531a179d230c055ff287196ad4e2bde977",
        "27d79fdd573bd940e5cde684b176f8442c8c125e7ff07bba97116bc56e1b69dd",
        "257789b1055cd7c1f41b9c1c3fdaeb0d9a35a6a34934bf23c259300468df0a79",
        "a8b887a07e7c0f27b295367493436c78cee199b64a9b71226958f032e0363d55",
        "86657957122768aff97a3c5ec4ec1352a0e76fdc867ce6e41fe63e8cc0d37255",
        "471920db0a7c067eb29c83386f26a28676bee0c354a3978f0314463f172601ea",
        "a83a86a6e54b24b074daab934fb7f56b542ac7aa16aa20d09bce9c78576e47f1",
        "54b39ccf98891115f7faf4d99b1f141e069999de8ad7c53efd2a61210532e39b",
        "c8f75bd955c4738fbd2e8050d0c57ff39bef593d708697ddee970ed43bcc5c4e",
        "a3355c45e1125bb859c57450a9df54c9ab19ff13da8b1c69f2b6a2a9953fbc8d",
        "9a1f081558378a384267cf1502052450cd553d5348b298dcd22ee1969bdf7ae6",
        "6dc7821936d81833f9c3cac295df62eab3bfe056f5d03dd1fe3abbc8167c6742",
        "bf63e999a1b7467c18dfa7737f984e743d70880ff1ae2dae49986f36d89aaade",
        "3033599c5d899f90df772b4f3a255db4b6d192dc40230310f23ef5d934409cce",
        "c3dd8942088dd7d05af591dcb3fac5da6008f0cc79676f87e2dc36f91191ee2f",
    ),
    "LGPL-2.1": (
        "798ee90550c0a574560f7ef3a92bedf49f535259e9b796a103e5ef34de83f349",
        "6c7e559e74818b9a78e56823b408fe16dbf9e1e6ac0e9e47d2d77ca301323f70",
        "f2ff11b627a52dc58900fab06ab669a766ba6f37100398e1145ed5e82d1453f1",
        "068244636de51f2b3ce4b36286e9b9f4fd1108fc8f0759388686ce5cbf1af364",
        "8723440352bcd2e28e93bbcf1c69e1daaeb694ac63d18f93f0e48f07f9e7cc4c",
        "122ff4e975b8c8ee07efb8f5c3aa722c9de48ecec61ad8b86ba1e44e2efcbeb9",
        "00189b70a6439036b47ee6cca6f5c24bdcecdc021df992c04f49fbeb47a686c8",
        "011bdfc1883ad0185f63eb95092145d0d65c55b6b0979ad82b1639047e87ec38",
        "eb370468d75374d9bc7e0cca513126bb2f3e780f5c542082448b4430ee5c5b99",
        "0020771aa45ee9c1a77c2eed2a73987f1220cf8e0582a9dd640e946b5b4394be",
        "a245904a54f1fefd61747632eb5bab3328e4e76d6eff64e3da25fa373e38a7a7",
        "56fe366f4c67db597b567cbbe1f3c0932ef5c3d83b29698b29155144054807fe",
    ),
    "LGPL-3.0": (
        "c15236b1a2318d6cdd819a5f6152950e890090bca8f0fed682a24765bb8b467a",
        "19f7261eb55f0b6ea2424552e510623de9f0182eda7e29b6fe7d745aa6242544",
        "46ffc2011d7960c20b0ddafefa3ffff903487eab554fb3d9a43a4cdce80caebf",
        "1c7694a8f3dd2cde7da4612d3c482296048e641e6de3c9840a2c0654aad4daa7",
    ),
    "MPL-2.0": (
        "38e1d5ec16c3272d3fa0fac4067be3ad8f4927dd23c8c611010d9ea50c29610d",
        "a3b44afeaa677a8d8e74e54c39dcac00e725d45763c0dccd734c4d999670b33b",
        "38d42b3a50bbb6042c4f69f2fefc0f04b88863422db6c62f419956eb2c27e7af",
        "94a7ea43d51798a293be46af6eea4da1a41bff3e449934eb8370194a85998585",
    ),
    "CC0-1.0": (
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
        "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32",
    ),
    "CC-BY-SA-4.0": (
        "73d6d12941bca06f3adb1966413db2659417a935b53f5457ce29a89a0e15a021",
        "6349339f9e657ab01def779ecd2d3e6ca88e6c9527dfe6cc331d49f3fe37ec7a",
    ),
    "Unlicense": (
        "788cc8843bf483eb3ea3b5f6c317b95502da6e7105963f7c57c872ceb263fd49",
        "e6e60d2037efe58841d698b341a609d8a738effceaadb12ac721e54f8e0bf7db",
    ),
}
