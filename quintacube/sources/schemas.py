"""Declared schemas of the source tables and of the run log."""

from __future__ import annotations

# Table and column names, types and NOT NULL flags of the retail data model.
SOURCE_DDL = {
    "tb001_uf": "tb001_sigla_uf string not null, tb001_nome_estado string not null",
    "tb002_cidades": (
        "tb002_cod_cidade int not null, tb001_sigla_uf string not null, "
        "tb002_nome_cidade string not null"
    ),
    "tb003_enderecos": (
        "tb003_cod_endereco int not null, tb001_sigla_uf string not null, "
        "tb002_cod_cidade int not null, tb003_nome_rua string not null, "
        "tb003_numero_rua string not null, tb003_complemento string, "
        "tb003_ponto_referencia string, tb003_bairro string not null, tb003_cep string not null"
    ),
    "tb004_lojas": (
        "tb004_cod_loja int not null, tb003_cod_endereco int, tb004_matriz int, "
        "tb004_cnpj_loja string not null, tb004_inscricao_estadual string"
    ),
    "tb005_funcionarios": (
        "tb005_matricula int not null, tb004_cod_loja int not null, "
        "tb003_cod_endereco int not null, tb005_nome_completo string not null, "
        "tb005_data_nascimento timestamp_ntz not null, tb005_cpf string not null, "
        "tb005_rg string not null, tb005_status string not null, "
        "tb005_data_contratacao timestamp_ntz not null, tb005_data_demissao timestamp_ntz"
    ),
    "tb005_006_funcionarios_cargos": (
        "tb005_matricula int not null, tb006_cod_cargo int not null, "
        "tb005_006_valor_cargo decimal(10,2) not null, "
        "tb005_006_perc_comissao_cargo decimal(5,2) not null, "
        "tb005_006_data_promocao timestamp_ntz not null"
    ),
    "tb006_cargos": "tb006_cod_cargo int not null, tb006_nome_cargo string not null",
    "tb010_clientes": (
        "tb010_cpf decimal(15,0) not null, tb010_nome string not null, "
        "tb010_fone_residencial string not null, tb010_fone_celular string"
    ),
    "tb010_012_vendas": (
        "tb010_012_cod_venda int not null, tb010_cpf decimal(15,0) not null, "
        "tb012_cod_produto int not null, tb005_matricula int not null, "
        "tb010_012_data timestamp_ntz not null, tb010_012_quantidade int not null, "
        "tb010_012_valor_unitario decimal(12,4) not null"
    ),
    "tb012_017_compras": (
        "tb012_017_cod_compra int not null, tb012_cod_produto int not null, "
        "tb017_cod_fornecedor int not null, tb012_017_data timestamp_ntz, "
        "tb012_017_quantidade int, tb012_017_valor_unitario decimal(12,2)"
    ),
    "tb012_produtos": (
        "tb012_cod_produto int not null, tb013_cod_categoria int not null, "
        "tb012_descricao string not null"
    ),
    "tb013_categorias": "tb013_cod_categoria int not null, tb013_descricao string not null",
    "tb014_prd_alimentos": (
        "tb014_cod_prd_alimentos int not null, tb012_cod_produto int not null, "
        "tb014_detalhamento string not null, tb014_unidade_medida string not null, "
        "tb014_num_lote string, tb014_data_vencimento timestamp_ntz, "
        "tb014_valor_sugerido decimal(10,2)"
    ),
    "tb015_prd_eletros": (
        "tb015_cod_prd_eletro int not null, tb012_cod_produto int not null, "
        "tb015_detalhamento string not null, tb015_tensao string, "
        "tb015_nivel_consumo_procel string, tb015_valor_sugerido decimal(10,2)"
    ),
    "tb016_prd_vestuarios": (
        "tb016_cod_prd_vestuario int not null, tb012_cod_produto int not null, "
        "tb016_detalhamento string not null, tb016_sexo string not null, tb016_tamanho string, "
        "tb016_numeracao decimal(3,0), tb016_valor_sugerido decimal(10,2)"
    ),
}

# The run id is made by the driver of the run, so it is text rather than a database sequence.
# `data_execucao` is when the run began, in each of its states; `data_estado` is when it got there.
LOG_DDL = (
    "id_log string not null, data_execucao timestamp_ntz, tipo_operacao string, status string, "
    "mensagem string, duracao interval day to second, erro_detalhado string, linha_erro int, "
    "data_estado timestamp_ntz"
)
